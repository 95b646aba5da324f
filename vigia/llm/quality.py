"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees over a bounded sample of labelled rows supply candidate rules (every path
from a root is a conjunction of thresholds); a lasso logistic fit keeps the few that matter; what
is kept compiles into one Spark column expression, so scoring is a projection. Only the sample
(``max_train`` rows of a few statistics each) goes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import PolyHash, raw_bytes, slices, words, written

STATS = ["words", "word_length", "punctuation", "symbols", "upper", "digits", "wide", "blanks",
         "distinct_words", "top_word", "lines", "distinct_lines", "line_words", "ended_lines"]

_KIND = np.zeros(256, np.int64)  # 0 lower letters and control characters
_KIND[[ord(c) for c in ".,;:'\"()-?"]] = 1
_KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 2
_KIND[65:91] = 3
_KIND[48:58] = 4
_KIND[128:] = 5
_KIND[[9, 10, 11, 12, 13, 32]] = 6


def statistics(texts: pa.Array) -> np.ndarray:
    """``STATS`` of each text, texts x statistics; an empty text has zeros."""
    texts = pc.fill_null(texts, "")
    body, offs = raw_bytes(texts)
    n, size = len(texts), np.diff(offs)
    text = np.repeat(np.arange(n), size)
    kinds = np.bincount(text * 7 + _KIND[body], minlength=n * 7).reshape(n, 7).astype(float)
    h, first, start, end = words(pc.utf8_lower(texts))
    many = np.diff(first)
    # lower-casing may change byte counts, so lines are found in the text as it is
    newline = body == 10
    cut = np.concatenate([[True], newline[:-1] | (np.diff(text) > 0)]) if len(body) else np.zeros(0, bool)
    line_start = np.flatnonzero(cut)
    line_end = np.concatenate([line_start[1:], [len(body)]])[:len(line_start)]
    line_hash = PolyHash(body).of(line_start, line_end - newline[line_end - 1]) if len(body) else np.zeros(0, np.uint64)
    line_first = np.searchsorted(line_start, offs)
    out = np.zeros((n, len(STATS)))
    letters = np.maximum(size, 1)
    out[:, 0] = np.log1p(many)
    out[:, 1] = size / np.maximum(many, 1)
    for at, kind in ((2, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 6)):
        out[:, at] = kinds[:, kind] / letters
    ended = np.zeros(len(line_start), bool)
    if len(body):
        last = body[np.maximum(line_end - 1 - newline[line_end - 1], line_start)]
        ended = np.isin(last, np.frombuffer(b".!?:;", np.uint8))
    for i in range(n):
        if many[i]:
            top = np.unique(h[first[i]:first[i + 1]], return_counts=True)[1]
            out[i, 8], out[i, 9] = len(top) / many[i], top.max() / many[i]
        a, b = line_first[i], line_first[i + 1]
        if b > a:
            out[i, 10] = np.log1p(b - a)
            out[i, 11] = len(np.unique(line_hash[a:b])) / (b - a)
            out[i, 12] = many[i] / (b - a)
            out[i, 13] = ended[a:b].mean()
    out[size == 0] = 0
    return out


def _statistics_task(prefix: str, drop_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cols = {n: c for n, c in zip(batch.schema.names, batch.columns) if not (drop_text and n == "text")}
            stats = statistics(batch.column("text"))
            for k, name in enumerate(STATS):
                cols[prefix + name] = pa.array(np.ascontiguousarray(stats[:, k]))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return run


def with_statistics(df: DataFrame, prefix: str = "s_", drop_text: bool = True) -> DataFrame:
    """``df`` with a column for each statistic of its ``text``."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if not (drop_text and f.name == "text"))
    return df.mapInArrow(_statistics_task(prefix, drop_text), ", ".join(filter(None, [kept, *(f"{prefix}{s} double" for s in STATS)])))


# ---- rules ---------------------------------------------------------------------------------

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above the threshold, threshold), all must hold


def _grow(bins: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, depth: int,
          rows: np.ndarray, path: Rule, rules: list[Rule], out: np.ndarray) -> None:
    """One regression tree over binned statistics; every path becomes a rule, leaves write ``out``."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best, choice = 1e-6, None
    if depth and len(rows) >= 20:
        for k in range(bins.shape[1]):
            top = len(edges[k]) + 1
            gs = np.cumsum(np.bincount(bins[rows, k], grad[rows], top))[:-1]
            hs = np.cumsum(np.bincount(bins[rows, k], hess[rows], top))[:-1]
            ns = np.cumsum(np.bincount(bins[rows, k], minlength=top))[:-1]
            gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
            gain[(ns < 5) | (len(rows) - ns < 5)] = 0
            if len(gain) and gain.max() > best + 1e-9:
                best, choice = gain.max(), (k, int(gain.argmax()))
    if choice is None:
        out[rows] += 0.3 * g / (h + 1)
        return
    k, at = choice
    above = bins[rows, k] > at
    for side in (False, True):
        rule = (*path, (k, side, float(edges[k][at])))
        rules.append(rule)
        _grow(bins, edges, grad, hess, depth - 1, rows[above == side], rule, rules, out)


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, above, edge in rule:
        out &= (x[:, k] > edge) == above
    return out


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, w: np.ndarray, steps: int = 400) -> np.ndarray:
    """Accelerated proximal gradient for logistic loss; the last weight (intercept) is free."""
    rate = 4 * len(y) / max(np.linalg.norm(r, 2) ** 2, 1e-9)
    v, t = w.copy(), 1.0
    for _ in range(steps):
        grad = r.T @ (1 / (1 + np.exp(-np.clip(r @ v, -30, 30))) - y) / len(y)
        new = v - rate * grad
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / s * (new - w), new, s
    return w


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self, prefix: str = "s_") -> Column:
        """The model as one column over the statistics' columns."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            test = F.lit(True)
            for k, above, edge in rule:
                c = F.col(prefix + STATS[k])
                test = test & ((c > edge) if above else (c <= edge))
            total = total + F.when(test, float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit_rules(x: np.ndarray, y: np.ndarray, *, trees: int = 30, depth: int = 3, bins: int = 32) -> RuleModel:
    """Rules and weights from statistics ``x`` and labels ``y`` (0/1); the penalty is the best of a
    path on a fifth of the rows. No rows: score 0.5; one class only: a constant near it."""
    prior = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else 0.0
    if len(np.unique(y)) < 2:
        return RuleModel(float(prior), [])
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    found: list[Rule] = []
    f = np.full(len(y), float(prior))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        _grow(binned, edges, y - p, p * (1 - p), depth, np.arange(len(y)), (), found, f)
    rules, columns, seen = [], [], set()
    for rule in found:
        hit = _holds(rule, x)
        key = hit.tobytes()
        if key not in seen and 5 <= hit.sum() <= len(y) - 5:
            seen.add(key)
            rules.append(rule)
            columns.append(hit)
    if not rules:
        return RuleModel(float(prior), [])
    r = np.column_stack([*columns, np.ones(len(y))]).astype(float)
    check = np.arange(len(y)) % 5 == 4
    w, best = np.append(np.zeros(len(rules)), prior), (np.inf, 0.0)
    for penalty in (0.03, 0.01, 0.003, 0.001, 0.0003):
        w = _lasso(r[~check], y[~check], penalty, w)
        z = r[check] @ w
        loss = np.mean(np.logaddexp(0, np.where(y[check] > 0, -z, z)))
        best = min(best, (loss, penalty))
    w = _lasso(r, y, best[1], np.append(np.zeros(len(rules)), prior))
    return RuleModel(float(w[-1]), [(rule, float(v)) for rule, v in zip(rules, w) if abs(v) > 1e-6])


# ---- Spark jobs ----------------------------------------------------------------------------

def _remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3))


def fit_quality(stats: DataFrame, labels: DataFrame, max_train: int = 20_000) -> RuleModel:
    """Fit on the labelled rows whose crc32(doc_id) mod 3 is not 1: the ``max_train`` of them with
    the least hash of the id. Null labels and ids are left out; a repeated id counts each time."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    marked = marked.filter("y is not null and doc_id is not null").filter(_remainder(F.col("doc_id")) != 1)
    cols = ["s_" + s for s in STATS]
    rows = (stats.filter("doc_id is not null").join(marked, "doc_id").select(F.xxhash64("doc_id").alias("o"), "y", *cols)
            .orderBy("o", "y", *cols).limit(max_train).collect())
    data = np.asarray([[r["y"], *(r[c] for c in cols)] for r in rows], float).reshape(len(rows), len(cols) + 1)
    return fit_rules(data[:, 1:], (data[:, 0] > 0.5).astype(float))


def score_quality(docs: DataFrame, labels: DataFrame, *, max_train: int = 20_000) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``.

    ``score`` comes from statistics of the whole text alone (null reads as empty, which has a
    score too); ``held_out`` says that crc32(doc_id as text) mod 3 is 1 (a null id: false), rows
    no label of which was used. Rows that repeat a ``doc_id`` are scored each. An empty table
    gives no rows; without labels every score is 0.5. Only ``doc_id``, ``text`` and ``quality``
    are read.
    """
    stats = written(with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))), "quality-statistics")
    model = fit_quality(stats, labels, max_train)
    held = F.coalesce(_remainder(F.col("doc_id")) == 1, F.lit(False))
    return stats.select("doc_id", held.alias("held_out"), model.score().alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, *, max_train: int = 20_000) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier scores 0.5 or more."""
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = labels.filter(_remainder(F.col("doc_id").cast("long")) != 1)
    model = fit_quality(with_statistics(cut.join(marked.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")), labels, max_train)
    row = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return with_statistics(row).filter(model.score() >= 0.5).select("row.*")
