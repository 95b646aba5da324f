"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors are lifted by one coordinate so that the largest inner product is the least distance.
Centroids come from balanced k-means on a bounded, documented sample; every vector is indexed. A
vector near a boundary goes into several lists (those within ``spread`` times its nearest centroid's
distance). Centroids are searched through an in-memory neighbour
graph, both to place vectors and to pick a query's lists; the lists whose centroid is within a
ratio of the nearest centroid's distance are read, however many they are.

The ratio is not a constant: a bounded number of queries is answered by brute force over all
vectors, and the ratio is the least that reaches the target recall on them. What the lists of the
rest would find at that ratio is measured, not assumed, whatever the number of vectors.

Lists and their queries meet in blocks of at most ``block`` rows a side, so no list, however full,
is one task's work. Scores are exact inner products in double precision; a query that finds too
few vectors is asked of every list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import written

VECTOR = "array<double>"


# ---- centroids and their graph -------------------------------------------------------------

def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ c.T + (c ** 2).sum(1), 0)


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means whose distances carry a penalty for full clusters; between rounds the emptiest
    centroids move into clusters of more than twice the mean size."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    load, rng = np.zeros(k), np.random.default_rng(5)
    for r in range(rounds):
        own, scale = np.zeros(len(x), np.int64), 0.0
        for at in range(0, len(x), 4096):
            d = _distances(x[at:at + 4096], c)
            scale = max(scale, d.min(1).mean())
            own[at:at + 4096] = (d + 0.2 * scale * load).argmin(1)
        count = np.bincount(own, minlength=k)
        load = count / count.mean() - 1
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        filled = count > 0
        c[filled] = total[filled] / count[filled, None]
        if r < rounds - 3:
            spare = iter(np.argsort(count, kind="stable")[:k // 4])
            for full in np.argsort(-count, kind="stable"):
                e = next(spare, None)
                if e is None or count[full] <= 2 * count.mean() or count[e] >= count.mean() / 2:
                    break
                c[e] = x[rng.choice(np.flatnonzero(own == full))]
                load[e] = load[full] = 0
    return c


@dataclass
class CentroidGraph:
    centroids: np.ndarray
    near: np.ndarray  # neighbours of each centroid
    entries: np.ndarray  # spread-out places to start from

    @classmethod
    def build(cls, c: np.ndarray, degree: int = 24, far: int = 8, entries: int = 24) -> CentroidGraph:
        k = len(c)
        degree, entries = min(degree, k), min(entries, k)
        near = np.concatenate([np.argsort(_distances(part, c), axis=1, kind="stable")[:, :degree] for part in np.array_split(c, -(-k // 1024))])
        links = np.random.default_rng(3).integers(0, k, (k, far))  # a few long links join distant groups
        start, gap = [0], _distances(c, c[:1])[:, 0]
        while len(start) < entries:
            start.append(int(gap.argmax()))
            gap = np.minimum(gap, _distances(c, c[start[-1:]])[:, 0])
        return cls(c, np.concatenate([near, links], axis=1), np.asarray(start))

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of the ``width`` nearest found for each row, nearest first:
        best-first search with a beam of that width, all rows at once."""
        n, k = len(x), len(self.centroids)
        width = min(width, k)
        beam = np.full((n, width), -1)
        dist = np.full((n, width), np.inf)
        done = np.ones((n, width), bool)
        norm = (self.centroids ** 2).sum(1)
        size = (x ** 2).sum(1)
        seen = np.zeros((n, k), bool)

        def offer(rows: np.ndarray, ids: np.ndarray) -> None:
            fresh = ~seen[rows[:, None], ids]
            first = np.sort(ids, axis=1)  # the same id may come twice in one offer
            if (first[:, 1:] == first[:, :-1]).any():
                order = np.argsort(ids, axis=1, kind="stable")
                ranked = np.take_along_axis(ids, order, 1)
                twice = np.concatenate([np.zeros((len(ids), 1), bool), ranked[:, 1:] == ranked[:, :-1]], axis=1)
                back = np.empty_like(twice)
                np.put_along_axis(back, order, twice, 1)
                fresh &= ~back
            seen[rows[:, None], ids] = True
            d = size[rows][:, None] + norm[ids] - 2 * np.einsum("nd,nkd->nk", x[rows], self.centroids[ids])
            d = np.where(fresh, np.maximum(d, 0), np.inf)
            all_d = np.concatenate([dist[rows], d], axis=1)
            keep = np.argsort(all_d, axis=1, kind="stable")[:, :width]
            dist[rows] = np.take_along_axis(all_d, keep, 1)
            beam[rows] = np.take_along_axis(np.concatenate([beam[rows], ids], axis=1), keep, 1)
            done[rows] = np.take_along_axis(np.concatenate([done[rows], ~fresh], axis=1), keep, 1)

        offer(np.arange(n), np.broadcast_to(self.entries, (n, len(self.entries))))
        while True:
            open_ = ~done & np.isfinite(dist)
            rows = np.flatnonzero(open_.any(1))
            if not len(rows):
                return beam, dist
            at = open_[rows].argmax(1)
            done[rows, at] = True
            offer(rows, self.near[beam[rows, at]])


def chosen_lists(graph: CentroidGraph, x: np.ndarray, spread: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(lists nearest first, which of them to use): each vector goes to its nearest
    list and, as one near a boundary, to the others within ``spread`` times that distance."""
    ids, dist = graph.search(x, max(most, 8))
    ok = np.isfinite(dist) & (dist <= spread ** 2 * dist[:, :1] + 1e-12)
    ok[:, most:] = False
    return ids, ok


# ---- tasks ---------------------------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _place_task(graph: CentroidGraph, reach: float, spread: float, most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            x = _matrix(b.column("v"))
            lift = np.sqrt(np.maximum(reach ** 2 - (x ** 2).sum(1), 0))
            lists, ok = chosen_lists(graph, np.column_stack([x, lift]), spread, most)
            pick = pa.array(np.repeat(np.arange(len(x)), ok.sum(1)))
            yield pa.RecordBatch.from_arrays([pa.array(lists[ok].astype(np.int32)), b.column("id").take(pick), b.column("v").take(pick)], ["list", "id", "v"])

    return run


def _asked(x: np.ndarray, reach: float) -> np.ndarray:
    """Queries as points among the lifted vectors; a query's length changes no order."""
    return np.column_stack([x * (reach / np.sqrt((x ** 2).sum(1)))[:, None], np.zeros(len(x))])


def probed_lists(graph: CentroidGraph, x: np.ndarray, ratio: float, width: int = 64) -> list[np.ndarray]:
    """The lists of each query within ``ratio`` of its nearest: the beam widens for the queries that
    fill it until none does, or it holds every list."""
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(x)
    left, lists = np.arange(len(x)), len(graph.centroids)
    while len(left):
        ids, dist = graph.search(x[left], width)
        ok = np.isfinite(dist) & (dist <= ratio ** 2 * dist[:, :1] + 1e-12)
        settled = ~ok.all(axis=1) | (width >= lists)
        for r in np.flatnonzero(settled):
            found[left[r]] = ids[r][ok[r]]
        left, width = left[~settled], width * 2
    return found


def _probe_task(graph: CentroidGraph, reach: float, ratio: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            found = probed_lists(graph, _asked(_matrix(b.column("v")), reach), ratio)
            pick = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            ids = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), b.column("id").take(pick), b.column("v").take(pick)], ["list", "id", "v"])

    return run


def _truth_task(q: np.ndarray, x: np.ndarray, k: int) -> Callable:
    """The ``k`` best of all vectors of a task for each of a few queries."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches, 4096):
            have, v = b.column("id").to_numpy(), _matrix(b.column("v"))
            if len(have):
                by = np.argsort(have, kind="stable")
                yield _top(q, x, have[by], v[by], k)

    return _best_of_task(scored, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


FINDS = "query_id long, vec_id long, score double"


def tuned_ratio(rows: DataFrame, postings: DataFrame, queries: DataFrame, graph: CentroidGraph, reach: float, k: int, trial: int,
                target: float) -> tuple[float, float]:
    """(the least ratio whose lists hold ``target`` of the true neighbours of ``trial`` queries, the
    share they hold): at most ``trial`` queries and ``trial * k`` neighbours reach the driver."""
    some = queries.orderBy(F.xxhash64("id"), "id").limit(trial).select("id", "v").toArrow().combine_chunks()
    if not some.num_rows:
        return 1.0, 1.0
    q, x = some["id"].to_numpy(), _matrix(some["v"].combine_chunks())
    truth = _ranked(rows.mapInArrow(_truth_task(q, x, k), FINDS).distinct(), k).select("query_id", "vec_id").collect()
    if not truth:
        return 1.0, 1.0
    ids = rows.sparkSession.createDataFrame([(i,) for i in sorted({r.vec_id for r in truth})], "id long")
    held: dict[int, list[int]] = {}
    for r in postings.select("id", "list").join(ids, "id", "left_semi").distinct().collect():
        held.setdefault(r["id"], []).append(r["list"])
    place = {int(i): n for n, i in enumerate(q)}
    points = _asked(x, reach)
    gap = np.sqrt(_distances(points, graph.centroids))
    needed = np.sort([min(gap[place[r.query_id], held[r.vec_id]]) / max(gap[place[r.query_id]].min(), 1e-12) for r in truth])
    ratio = float(needed[int(np.ceil(target * len(needed))) - 1]) * (1 + 1e-9)

    def share(at: float) -> float:
        lists = [set(f.tolist()) for f in probed_lists(graph, points, at)]
        return float(np.mean([any(h in lists[place[r.query_id]] for h in held[r.vec_id]) for r in truth]))

    reached = share(ratio)
    while reached < target and ratio < needed[-1] * 2:  # the graph may miss a list that the ratio allows
        ratio *= 1.02
        reached = share(ratio)
    return ratio, reached


def _top(q: np.ndarray, x: np.ndarray, have: np.ndarray, v: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` best of the vectors ``v`` (ids ``have``, ascending) for each query.

    A matrix product finds all that may be among them; their scores are then summed pair by
    pair, so that equal vectors score exactly the same and the smaller id wins.
    """
    s = x @ v.T
    s[q[:, None] == have] = -np.inf
    least = np.partition(s, max(s.shape[1] - k, 0), axis=1)[:, max(s.shape[1] - k, 0)]
    row, col = np.nonzero((s >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) & (s > -np.inf))
    score = np.einsum("nd,nd->n", x[row], v[col])
    by = np.lexsort((col, -score, row))
    row, col, score = row[by], col[by], score[by]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    ok = place < k
    return pa.RecordBatch.from_arrays([pa.array(q[row[ok]]), pa.array(have[col[ok]]), pa.array(score[ok])], ["query_id", "vec_id", "score"])


def _merged(found: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    """The ``k`` best rows of each query over several finds; a vector found in two lists counts once."""
    rows = pa.concat_batches(found)
    q, i, score = (rows.column(c).to_numpy() for c in ("query_id", "vec_id", "score"))
    by = np.lexsort((i, -score, q))
    q, i, score = q[by], i[by], score[by]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1]) | (score[1:] != score[:-1])
    q, i, score = q[fresh], i[fresh], score[fresh]
    ok = np.arange(len(q)) - np.searchsorted(q, q) < k
    return pa.RecordBatch.from_arrays([pa.array(q[ok]), pa.array(i[ok]), pa.array(score[ok])], ["query_id", "vec_id", "score"])


def _best_of_task(tiles: Callable, k: int, most: int = 1 << 17) -> Callable:
    """A task's finds combined before the exchange: each query's ``k`` best over all of the task's
    tiles. About ``most`` rows are held; beyond that what is there goes out as it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for found in tiles(batches):
            held.append(found)
            if sum(b.num_rows for b in held) >= most:
                held = [_merged(held, k)]
                if held[0].num_rows >= most // 2:
                    yield held.pop()
        if held:
            yield _merged(held, k)

    return run


def _score_task(k: int) -> Callable:
    """Rows sorted by (list, block, chunk, kind): a block's vectors, then the queries asked of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, ids, vectors = None, [], []
        for b in batches:
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("list", "block", "chunk", "kind")])
            new = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [b.num_rows]])
            for lo, hi in zip(new, new[1:]):
                if hi == lo:
                    continue
                here = tuple(keys[:3, lo])
                if here != tile:
                    tile, ids, vectors = here, [], []
                part = b.slice(lo, hi - lo)
                name, x = part.column("id").to_numpy(), _matrix(part.column("v"))
                if keys[3, lo] == 0:
                    ids.append(name)
                    vectors.append(x)
                elif ids:
                    have, v = np.concatenate(ids), np.concatenate(vectors)
                    by = np.argsort(have, kind="stable")
                    ids, vectors = [have[by]], [v[by]]
                    have, v = ids[0], vectors[0]
                    for at in range(0, len(name), 256):
                        yield _top(name[at:at + 256], x[at:at + 256], have, v, k)

    return run


# ---- Spark jobs ----------------------------------------------------------------------------

def _best(postings: DataFrame, asked: DataFrame, k: int, block: int) -> DataFrame:
    """The ``k`` best vectors of each query over the lists it asks."""
    parts = lambda df, name: df.groupBy("list").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias(name))
    sizes = parts(postings, "blocks").join(parts(asked, "chunks"), "list")
    share = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    vectors = postings.join(sizes, "list").select("list", share("blocks").alias("block"), each("chunks").alias("chunk"), F.lit(0).alias("kind"), "id", "v")
    queries = asked.join(sizes, "list").select("list", each("blocks").alias("block"), share("chunks").alias("chunk"), F.lit(1).alias("kind"), "id", "v")
    tile = ["list", "block", "chunk"]
    found = (vectors.unionByName(queries).repartition(*tile).sortWithinPartitions(*tile, "kind")
             .mapInArrow(_best_of_task(_score_task(k), k), FINDS).distinct())
    return _ranked(found, k)


def nearest(embeddings: DataFrame, *, k: int = 20, every: int = 20, sample: int = 20_000, sample_values: int = 8_000_000,
            lists_per_root: float = 0.4, most_lists: int = 4096, spread: float = 1.02, copies: int = 2, trial: int = 64,
            recall: float = 0.95, probe: float | None = None, block: int = 2048) -> DataFrame:
    """``query_id, rank, vec_id, score, measured_recall``: the ``k`` vectors with the largest inner product found for
    each query, nearest first, ties to the smaller ``vec_id``.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates all rows but the
    query's own. Vectors that are null, zero, hold null or non-finite components, have no
    ``vec_id``, or another length than most take no part. Rows equal in ``vec_id`` and vector
    count once; rows that share only the ``vec_id`` are all candidates, and the least vector
    asks. With fewer than ``k`` candidates all are returned. An empty table gives no rows. Only
    ``vec_id`` and ``embedding`` are read.

    The centroids are fitted on at most ``sample`` rows (and ``sample_values`` numbers). Lists are read
    within the ratio that holds ``recall`` of the true neighbours of ``trial`` queries, found by
    brute force over all vectors; ``measured_recall`` is the share it does hold. A ``probe`` is a
    ratio given instead (nothing is measured then).
    """
    spark = embeddings.sparkSession
    v = F.col("v")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast(VECTOR).alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)).distinct()
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, measured_recall double")
    if most is None:
        return empty
    rows = written(rows.filter(F.size("v") == most.d), "ann-vectors")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, reach = rows.agg(F.count("*"), F.max(length)).first()
    take = max(1, min(sample, sample_values // most.d))
    x = _matrix(rows.orderBy(F.xxhash64("id"), "id", "v").limit(take).select("v").toArrow()["v"].combine_chunks())
    x = np.column_stack([x, np.sqrt(np.maximum(reach ** 2 - (x ** 2).sum(1), 0))])
    lists = max(1, min(int(lists_per_root * n ** 0.5), most_lists, len(x) // 8))
    graph = CentroidGraph.build(balanced_centroids(x, lists))

    shape = f"list int, id long, v {VECTOR}"
    postings = written(rows.mapInArrow(_place_task(graph, reach, spread, copies), shape), "ann-postings")
    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    ratio, reached = (probe, None) if probe is not None else tuned_ratio(rows, postings, queries, graph, reach, k, trial, recall)
    best = written(_best(postings, queries.mapInArrow(_probe_task(graph, reach, ratio), shape), k, block), "ann-best")
    enough = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = queries.join(enough, "id", "left_anti")
    if short.limit(1).count():
        every_list = postings.select("list").distinct()
        asked = short.withColumn("lists", F.sequence(F.lit(0), F.lit(lists - 1))).select(F.explode("lists").alias("list"), "id", "v").join(every_list, "list", "left_semi")
        again = _best(postings, asked.select("list", "id", "v"), k, block)
        best = best.join(enough.select(F.col("id").alias("query_id")), "query_id", "left_semi").unionByName(again)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.lit(reached).cast("double").alias("measured_recall"))
