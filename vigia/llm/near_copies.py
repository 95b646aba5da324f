"""N-gram Jaccard join: MinHash bands find candidate pairs, full n-gram sets decide them.

Texts are compared as sets of word n-grams (lower case, words split at ASCII white space; a text
of fewer words is one n-gram). Equal word sequences collapse into one node first, so copies
never pair up with each other. Each node's MinHash signature is cut into bands; nodes that share
a band are candidates. ``bands`` and ``rows`` are chosen for the target recall at the similarity
threshold: a pair at similarity s is met with probability 1 - (1 - s**rows)**bands.

Each candidate pair belongs to one tile: that of the first band it shares. A first pass, over
signatures only, finds the nodes with pairs in a tile; their texts then meet there and every pair
is verified. A band of many nodes is split into blocks, two a tile, so a task holds a bounded
number of texts. Pairs are never written out: a tile returns each node's links counted and the
root of its local component. Components join by contraction in a random order of the nodes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import documents, mix, slices, words, written

_ODD = (np.random.default_rng(7).integers(1, 2**62, 64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` values that meet a pair at ``similarity`` with at least ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))


# ---- n-grams and signatures ----------------------------------------------------------------

def ngrams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram hashes of all texts (with repeats) and the first n-gram of each text."""
    many = np.diff(first)
    count = np.where(many >= n, many - n + 1, np.minimum(many, 1))
    text = np.repeat(np.arange(len(many)), count)
    begin = np.cumsum(count) - count
    at = first[text] + np.arange(len(text)) - begin[text]
    size = np.minimum(many[text], n)
    g = size.astype(np.uint64) * _ODD[63]
    for k in range(n):
        ok = slice(None) if k == 0 else np.flatnonzero(size > k)
        g[ok] += h[at[ok] + k] * _ODD[k]
    return mix(g), np.concatenate([begin, [len(text)]])


def signatures(g: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands) of texts with at least one n-gram; band number in the top bits."""
    factors = (np.random.default_rng(11).integers(1, 2**62, bands * rows).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
    starts = first[:-1]
    out = np.zeros((len(starts), bands), np.uint64)
    for b in range(bands):
        key = np.zeros(len(starts), np.uint64)
        for r in range(rows):
            f = factors[b * rows + r]
            key = key * _ODD[40] + np.minimum.reduceat((g ^ f) * f, starts)
        out[:, b] = (mix(key) >> np.uint64(8)) | (np.uint64(b) << np.uint64(56))
    return out


def _sequence_keys(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's word sequence."""
    place = (np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64)
    keys = []
    for seed in (_ODD[50], _ODD[51]):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h ^ mix(place * seed + np.uint64(1))) , out=total[1:])
        keys.append(mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)))
    return keys[0], keys[1]


def _signature_task(n: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            h, first, _, _ = words(pc.utf8_lower(batch.column("text")))
            keep = np.flatnonzero(np.diff(first) > 0)
            batch = batch.take(pa.array(keep))
            first = np.concatenate([first[keep], first[-1:]])
            a, b = _sequence_keys(h, first)
            g, at = ngrams(h, first, n)
            sig = signatures(g, at, bands, rows) if len(keep) else np.zeros((0, bands), np.uint64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("k"), batch.column("h"),
                pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1, dtype=np.int32) * bands), pa.array(sig.ravel().view(np.int64)))],
                ["doc_id", "k", "h", "a", "b", "bands"])

    return run


# ---- tiles ---------------------------------------------------------------------------------

def _gram_sets(text: pa.Array, n: int) -> list[np.ndarray]:
    """The n-gram set of each text, sorted. Words and their places are held for a slice of texts only."""
    sets: list[np.ndarray] = []
    for part in slices(iter([pa.RecordBatch.from_arrays([text], ["text"])])):
        h, first, _, _ = words(pc.utf8_lower(part.column("text")))
        g, begin = ngrams(h, first, n)
        sets += [np.unique(g[a:b]) for a, b in zip(begin[:-1], begin[1:])]
    return sets


def _whole_tiles(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by (band, bi, bj), cut between tiles: (rows, first row of each tile and the end).

    A row equal in tile and node to the one before it is dropped (documents equal in id and text
    bring their node's text more than once)."""
    held: list[pa.RecordBatch] = []
    last: np.ndarray | None = None

    def starts(batch: pa.RecordBatch) -> np.ndarray:
        key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("band", "bi", "bj")])
        return np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("band", "bi", "bj", "a", "b")])
        fresh = np.ones(batch.num_rows, bool)
        fresh[1:] = (key[:, 1:] != key[:, :-1]).any(0)
        fresh[0] = last is None or bool((key[:, 0] != last).any())
        last = key[:, -1]
        held.append(batch if fresh.all() else batch.filter(pa.array(fresh)))
        if sum(b.num_rows for b in held) >= rows:
            whole = pa.concat_batches(held)
            at = starts(whole)
            held = [whole.slice(at[-1])]
            if len(at) > 1:
                yield whole.slice(0, at[-1]), at
    if held:
        whole = pa.concat_batches(held)
        if whole.num_rows:
            yield whole, np.append(starts(whole), whole.num_rows)


def _tile_pairs(batch: pa.RecordBatch, at: np.ndarray, most: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i < j) of the same tile whose first shared band is the tile's band, some at a time.

    In a tile of two blocks only pairs across the blocks count, so every pair counts once."""
    band = batch.column("band").to_numpy().view(np.uint64)
    vectors = batch.column("bands").flatten().to_numpy().reshape(batch.num_rows, -1).view(np.uint64)
    number = (band >> np.uint64(56)).astype(np.int64)
    block, bi, bj = (batch.column(c).to_numpy() for c in ("block", "bi", "bj"))
    size = np.diff(at)
    for m in np.unique(size[size > 1]):
        one, two = np.triu_indices(m, 1)
        first = at[:-1][size == m]
        for lo in range(0, len(first) * len(one), most):  # pairs of all tiles of this size, numbered
            tile, pair = np.divmod(np.arange(lo, min(lo + most, len(first) * len(one))), len(one))
            i, j = first[tile] + one[pair], first[tile] + two[pair]
            ok = (bi[i] == bj[i]) | (block[i] != block[j])
            i, j = i[ok], j[ok]
            shared = vectors[i] == vectors[j]
            mine = shared.argmax(axis=1) == number[i]
            yield i[mine], j[mine]


def _meeting_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each tile, the nodes that have a pair to verify there."""
    for batch, at in _whole_tiles(batches):
        used = np.zeros(batch.num_rows, bool)
        for i, j in _tile_pairs(batch, at):
            used[i] = used[j] = True
        yield batch.filter(pa.array(used))


def _shared_counts(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Common n-grams of each two of the given sets, by products of 0/1 matrices of their n-grams."""
    gram = np.concatenate([sets[r] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    _, col, many = np.unique(gram, return_inverse=True, return_counts=True)
    keep = many[col] > 1
    owner, col = owner[keep], np.unique(col[keep], return_inverse=True)[1]
    out = np.zeros((len(rows), len(rows)))
    by = np.argsort(col, kind="stable")
    owner, col = owner[by], col[by]
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, 8192):
        a, b = np.searchsorted(col, [lo, lo + 8192])
        x = np.zeros((len(rows), min(8192, int(col[-1]) + 1 - lo)), np.float32)
        x[owner[a:b], col[a:b] - lo] = 1
        out += x @ x.T
    return out


def _verify_task(n: int, similarity: float) -> Callable:
    """Per node and tile: the copies it is linked to there, and its local component's least row.

    No link is written out: each counts in the one tile that its pair belongs to, and a spanning
    forest of a tile's links joins the same nodes as all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at in _whole_tiles(slices(batches), 512):
            sets = _gram_sets(batch.column("text"), n)
            size = np.asarray([len(x) for x in sets], float)
            tile = np.repeat(np.arange(len(at) - 1), np.diff(at))
            copies = batch.column("copies").to_numpy()
            around, root = np.zeros(batch.num_rows, np.int64), np.arange(batch.num_rows)
            matrices: dict[int, np.ndarray] = {}
            for i, j in _tile_pairs(batch, at):
                near = np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j])
                i, j = i[near], j[near]
                common = np.zeros(len(i))
                for t in np.unique(tile[i]):
                    own = np.flatnonzero(tile[i] == t) if at[t + 1] - at[t] > 8 else None
                    if own is not None and len(own) > 16:
                        if t not in matrices:
                            matrices = {t: _shared_counts(sets, np.arange(at[t], at[t + 1]))}
                        common[own] = matrices[t][i[own] - at[t], j[own] - at[t]]
                        continue
                    for k in np.flatnonzero(tile[i] == t) if own is None else own:
                        both = np.concatenate([sets[i[k]], sets[j[k]]])
                        both.sort(kind="stable")
                        common[k] = np.count_nonzero(both[1:] == both[:-1])
                linked = common >= similarity * (size[i] + size[j] - common) - 1e-9
                i, j = i[linked], j[linked]
                np.add.at(around, i, copies[j])
                np.add.at(around, j, copies[i])
                while len(i):  # least row of each local component
                    low = np.minimum(root[i], root[j])
                    open_ = root[i] != root[j]
                    if not open_.any():
                        break
                    np.minimum.at(root, root[i], low)
                    np.minimum.at(root, root[j], low)
                    root = root[root]
            while (root[root] != root).any():
                root = root[root]
            own = np.flatnonzero(around > 0)
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a[own], b[own], around[own], a[root[own]], b[root[own]])],
                                             ["a", "b", "around", "ra", "rb"])

    return run


# ---- classes -------------------------------------------------------------------------------

def connected(edges: DataFrame, name: str) -> DataFrame:
    """Component label (least node) of each node of ``edges`` (x, y): ``x, label``.

    By contraction: each round orders the nodes anew by a hash, every node goes to the least of
    itself and its neighbours, and the edges between the nodes gone to are the next round's. No
    node goes to the last one of a component, so rounds end, when no edge is left; an expected
    constant share of the nodes goes each round, however ids lie along a path, so rounds grow with
    the logarithm of the nodes and all of them write a few times the edges. Then the places nodes
    went to are followed back, from the last round to the first.
    """
    both = written(edges.select("x", "y").union(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), f"{name}-edges")
    every, went = both.select("x").distinct(), []
    both = both.filter("x <> y")
    while both.limit(1).count():
        x, y = (F.struct(F.xxhash64(c, F.lit(len(went))).alias("order"), F.col(c).alias("node")) for c in ("x", "y"))
        to = written(both.groupBy("x").agg(F.min(y).alias("near")).select("x", F.least("near", x)["node"].alias("to")), f"{name}-went")
        went.append(to)
        both = both.join(to, "x").select("y", F.col("to").alias("x"))
        both = both.join(to.select(F.col("x").alias("y"), F.col("to").alias("z")), "y").filter("x <> z").select("x", F.col("z").alias("y"))
        both = written(both.distinct(), f"{name}-edges")
    end = every.select("x", F.col("x").alias("end"))
    if went:
        end = went.pop().withColumnRenamed("to", "end")
        for to in reversed(went):
            end = to.join(end.withColumnRenamed("x", "to"), "to", "left").select("x", F.coalesce("end", "to").alias("end"))
            end = written(end, f"{name}-ends")
        end = written(every.join(end, "x", "left").select("x", F.coalesce("end", "x").alias("end")), f"{name}-ends")
    return end.join(end.groupBy("end").agg(F.min("x").alias("label")), "end").select("x", "label")


def _keyed(docs: DataFrame) -> DataFrame:
    """``k, h`` name a row up to rows that are equal in ``doc_id`` and text."""
    return documents(docs).select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("k"),
                                  F.xxhash64("text", F.col("doc_id").isNull()).alias("h"), "text")


def _node() -> Column:
    return F.struct("a", "b")


def _classes(docs: DataFrame, n: int, similarity: float, bands: int, rows: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(rows with words: doc_id, k, h, node; nodes: node, label, links, copies)."""
    texts = _keyed(docs)
    seen = written(texts.mapInArrow(_signature_task(n, bands, rows), "doc_id long, k long, h long, a long, b long, bands array<long>"), "near-signatures")
    nodes = written(seen.groupBy("a", "b").agg(F.count("*").alias("copies"), F.min(F.struct("k", "h")).alias("rep"), F.any_value("bands").alias("bands"))
                    .select(_node().alias("node"), "copies", "rep", "bands"), "near-nodes")

    # tiles: the nodes of one band, in blocks of about ``block`` nodes; a tile holds two blocks
    spread = nodes.select(F.explode("bands").alias("band"), "node")
    parts = spread.groupBy("band").agg(F.count("*").alias("m")).filter("m > 1").select("band", F.ceil(F.col("m") / block).cast("int").alias("parts"))
    met = spread.join(parts, "band").select("band", "node", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = met.select("band", "node", "block", other.alias("other")).select(
        "band", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "node")
    tile = ["band", "bi", "bj"]
    kept = "band long, bi int, bj int, block int, a long, b long, k long, h long, copies long, bands array<long>"
    met = met.join(nodes.select("node", "rep", "copies", "bands"), "node").select(
        *tile, "block", "node.a", "node.b", "rep.k", "rep.h", "copies", "bands")
    met = met.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(_meeting_task, kept)
    work = texts.select("k", "h", "text").join(written(met, "near-meetings"), ["k", "h"]).drop("k", "h")
    found = written(work.repartition(*tile).sortWithinPartitions(*tile, "a", "b").mapInArrow(
        _verify_task(n, similarity), "a long, b long, around long, ra long, rb long"), "near-links")

    label = connected(found.select(_node().alias("x"), F.struct(F.col("ra").alias("a"), F.col("rb").alias("b")).alias("y")), "near")
    degree = found.groupBy("a", "b").agg(F.sum("around").alias("around")).select(_node().alias("node"), "around")
    nodes = (nodes.select("node", "copies", "rep").join(label.toDF("node", "label"), "node", "left").join(degree, "node", "left")
             .select("node", "copies", "rep", F.coalesce("label", "node").alias("label"),
                     (F.col("copies") - 1 + F.coalesce("around", F.lit(0))).alias("links")))
    return seen.select("doc_id", "k", "h", _node().alias("node")), written(nodes, "near-classes")


def near_copies(docs: DataFrame, *, n: int = 5, similarity: float = 0.8, recall: float = 0.99999, rows: int = 5, block: int = 256) -> DataFrame:
    """Per document: ``doc_id, class_id, n_links``.

    Two documents are linked where the Jaccard similarity of their word n-gram sets reaches
    ``similarity``; ``n_links`` counts a document's links, copies included, and ``class_id`` is
    the least ``doc_id`` among the documents that links connect. A text without words (null,
    empty, blanks) has no links and its own ``doc_id`` as class. Rows that repeat a ``doc_id``
    or have none are documents of their own. An empty table gives no rows. Only ``doc_id`` and
    ``text`` are read.
    """
    seen, nodes = _classes(docs, n, similarity, bands_for(similarity, recall, rows), rows, block)
    least = seen.groupBy("node").agg(F.min("doc_id").alias("least"))
    named = nodes.join(least, "node").select("node", "label", "links", "least")
    name = named.groupBy("label").agg(F.min("least").alias("class_id"))
    named = written(named.join(name, "label").select("node", "class_id", F.col("links").alias("n_links")), "near-named")
    worded = seen.select("doc_id", "node").join(named, "node").select("doc_id", "class_id", "n_links")
    blank = documents(docs).filter(~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return worded.unionByName(blank.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def one_of_each_class(docs: DataFrame, *, n: int = 5, similarity: float = 0.8, recall: float = 0.99999, rows: int = 5, block: int = 256) -> DataFrame:
    """The rows of ``docs``, all columns, one of each class (least ``doc_id``, then text hash);
    texts without words all stay."""
    seen, nodes = _classes(docs, n, similarity, bands_for(similarity, recall, rows), rows, block)
    first = nodes.groupBy("label").agg(F.min("rep").alias("rep")).select("rep.k", "rep.h")
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("row"), F.coalesce(doc_id, F.lit(0)).alias("k"), F.xxhash64(text, doc_id.isNull()).alias("h"),
                        text.rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    same = Window.partitionBy("k", "h").orderBy(F.xxhash64(F.to_json("row")))
    kept = keyed.filter("worded").join(first, ["k", "h"]).withColumn("rank", F.row_number().over(same)).filter("rank = 1")
    return kept.select("row.*").unionByName(keyed.filter("not worded").select("row.*"))
