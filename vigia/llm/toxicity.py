"""Toxicity as ordered severity: cumulative-link logistic regression on sparse word features.

P(severity > j) = sigmoid(w . x - threshold_j): one weight vector is shared by all ordered
thresholds. Features are the words present in a text (lower case) and their beginnings (so that
inflected and compound forms count together), hashed into ``2**BITS`` buckets; a distributed
count over the training rows keeps the buckets that tell the classes apart. Labels only say toxic or not, so the toxic training rows are graded by how often they use
words that the counts show to be toxic: grades 1 to ``GRADES`` at that rate's quantiles.
The expected severity is the sum of the cumulative probabilities.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import PolyHash, mix, raw_bytes, slices, words

BITS = 20
STEMS = (4, 5, 7)
GRADES = 3


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and of its beginnings of ``STEMS`` bytes."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    h, first, start, end = words(lower, alnum=True)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    job, found = PolyHash(raw_bytes(lower)[0]), [(text, h)]
    for k in STEMS:
        longer = end - start > k
        at = start[longer]
        found.append((text[longer], mix(job.of(at, at + k) ^ np.uint64(k << 32))))
    return np.concatenate([t for t, _ in found]), (np.concatenate([x for _, x in found]) >> np.uint64(64 - BITS)).astype(np.int64)


def _present_task(chosen: np.ndarray | None) -> Callable:
    """Rows (o, toxic, bucket, times): the words of each training text, once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text, bucket = _buckets(batch.column("text"))
            if chosen is not None:
                own = np.isin(bucket, chosen)
                text, bucket = text[own], bucket[own]
            key, times = np.unique(text << BITS | bucket, return_counts=True)
            pick = pa.array(key >> BITS)
            yield pa.RecordBatch.from_arrays([
                batch.column("o").take(pick), batch.column("toxic").take(pick),
                pa.array((key & ((1 << BITS) - 1)).astype(np.int32)), pa.array(times.astype(np.int32))], ["o", "toxic", "bucket", "times"])

    return run


@dataclass
class OrdinalModel:
    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def severity(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(expected severity, P(severity > 0)) of each text."""
        dense = np.zeros(1 << BITS)
        dense[self.buckets] = self.weights
        text, bucket = _buckets(texts)
        own = dense[bucket] != 0
        key = np.unique(text[own] << BITS | bucket[own])
        z = np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], len(texts))
        p = 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds, -500, 500)))
        return p.sum(axis=1), p[:, 0]


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, n: int, m: int, grade: np.ndarray, *, ridge: float = 1e-3,
                steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by full-batch Adam; (rows, cols) are the ones of X (n x m).

    Thresholds are a first value and positive steps, so their order holds throughout.
    """
    top = int(max(grade.max(initial=0), 1))
    share = np.clip([(grade > j).mean() if n else 0.5 for j in range(top)], 1e-4, 1 - 1e-4)
    cut = -np.log(share / (1 - share))
    v = np.concatenate([np.zeros(m), cut[:1], np.log(np.maximum(np.diff(cut), 0.05))])
    mean, var = np.zeros_like(v), np.zeros_like(v)
    for t in range(1, steps + 1):
        w, theta = v[:m], np.cumsum(np.concatenate([v[m:m + 1], np.exp(v[m + 1:])]))
        z = np.bincount(rows, w[cols], n)
        above = 1 / (1 + np.exp(-np.clip(z[:, None] - theta, -30, 30)))  # P(grade > j)
        full = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        p = np.maximum(full[np.arange(n), grade] - full[np.arange(n), grade + 1], 1e-12)
        slope = np.concatenate([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))], axis=1)
        lower, upper = slope[np.arange(n), grade] / p, slope[np.arange(n), grade + 1] / p
        dz = -(lower - upper) / n
        dtheta = np.array([(lower[grade == j + 1].sum() - upper[grade == j].sum()) / n for j in range(top)])
        tail = np.cumsum(dtheta[::-1])[::-1]
        grad = np.concatenate([np.bincount(cols, dz[rows], m) + ridge * w, tail[:1], tail[1:] * np.exp(v[m + 1:])])
        mean = 0.9 * mean + 0.1 * grad
        var = 0.999 * var + 0.001 * grad ** 2
        v = v - 0.1 * (mean / (1 - 0.9 ** t)) / (np.sqrt(var / (1 - 0.999 ** t)) + 1e-9)
    return v[:m], np.cumsum(np.concatenate([v[m:m + 1], np.exp(v[m + 1:])]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, max_train: int = 20_000, features: int = 2_000, least_docs: int = 3) -> OrdinalModel:
    """Fit on at most ``max_train`` labelled rows (the least hashes of the id), over the ``features``
    buckets whose presence differs most between the classes. Null labels and ids are left out."""
    spark = docs.sparkSession
    nothing = OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.array([20.0 + j for j in range(GRADES)]))
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter("doc_id is not null and toxic is not null").withColumn("o", F.xxhash64("doc_id")).orderBy("o", "toxic").limit(max_train))
    sample = [(r.doc_id, r.o, int(r.toxic > 0)) for r in marked.collect()]
    n1 = sum(t for _, _, t in sample)
    if not n1 or n1 == len(sample):
        return nothing
    # at most max_train small rows: bounded by that parameter, so it may be sent to every task
    chosen = F.broadcast(spark.createDataFrame(sample, "doc_id long, o long, toxic int"))
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    shape = "o long, toxic int, bucket int, times int"
    n0, n1 = float(len(sample) - n1), float(n1)
    counts = train.mapInArrow(_present_task(None), shape).groupBy("bucket").agg(
        F.count("*").alias("d"), F.sum("toxic").alias("d1")).filter(F.col("d") >= least_docs)
    odds = F.log((F.col("d1") + 0.5) / (n1 + 1)) - F.log((F.col("d") - F.col("d1") + 0.5) / (n0 + 1))
    spread = 1 / (F.col("d1") + 0.5) + 1 / (F.col("d") - F.col("d1") + 0.5)
    best = counts.select("bucket", "d1", odds.alias("odds"), (odds / F.sqrt(spread)).alias("z")).orderBy(F.abs("z").desc(), "bucket").limit(features).collect()
    if not best:
        return nothing
    buckets = np.asarray(sorted(r.bucket for r in best), np.int64)
    told = np.isin(buckets, [r.bucket for r in best if r.z > 4 and r.odds > 2])
    got = train.mapInArrow(_present_task(buckets), shape).toArrow()
    place = {o: i for i, o in enumerate(sorted({s[1] for s in sample}))}
    grade = np.zeros(len(place), np.int64)
    for _, o, t in sample:
        grade[place[o]] = max(grade[place[o]], t)
    rows = np.searchsorted(np.asarray(list(place), np.int64), got["o"].to_numpy())
    cols = np.searchsorted(buckets, got["bucket"].to_numpy())
    use = np.bincount(rows, told[cols] * got["times"].to_numpy().astype(float), len(place))
    bad = grade > 0
    cuts = np.unique(np.quantile(use[bad], np.arange(1, GRADES) / GRADES)) if bad.any() else np.zeros(0)
    grade[bad] = 1 + np.searchsorted(cuts, use[bad], side="left")
    weights, thresholds = fit_ordinal(rows, cols, len(place), len(buckets), grade)
    return OrdinalModel(buckets, weights, thresholds)


def _score_task(model: OrdinalModel) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            severity, p = model.severity(batch.column("text"))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(severity), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                ["doc_id", "severity", "p_toxic", "toxic"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, *, max_train: int = 20_000) -> DataFrame:
    """Per document: ``doc_id, severity, p_toxic, toxic``.

    ``severity`` is the expected grade (0 to 3) from the words of the whole text, ``p_toxic`` the
    probability of any grade above 0, ``toxic`` 1 where that reaches 0.5. Null and empty texts
    are scored as texts without words. Rows that repeat a ``doc_id`` are scored each; in the
    labels the higher label of a repeated id counts. Without labels of both classes nothing is
    toxic. An empty table gives no rows. Only ``doc_id``, ``text`` and ``toxic`` are read.
    """
    model = fit_toxicity(docs, labels, max_train=max_train)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score_task(model), "doc_id long, severity double, p_toxic double, toxic int")
