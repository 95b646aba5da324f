"""Removes every byte covered by a long string that also starts anywhere else in the corpus.

Method: hash-compared suffix sort. A full suffix array of the corpus would cost many times its
size, so the suffixes are first cut down to buckets that can hold a repeat:

1. *Anchors.* Each window of ``length`` bytes elects its leftmost minimal ``gram``-byte hash.
   Equal windows elect the same gram at the same offset, so a repeated window's anchor hash
   repeats. A run of windows that share an anchor, and the bytes they cover, is its *context*.
2. *Counting.* Anchors are counted with map-side combination (occurrences, least and greatest
   context hash). An anchor met once ends here. One met more often in a single context is a
   repeat as it stands; the others, met in different contexts, go on.
3. *Suffix sort.* Distinct contexts are gathered by anchor with their bytes. Within an anchor
   the suffixes at each offset are merge-sorted; two suffixes are compared by binary search for
   their common extension over prefix polynomial hashes (logarithmic in ``length``), and
   neighbours whose extension reaches ``length`` are compared byte by byte before they count.
4. Anchors with more distinct contexts than ``group`` (a passage shared by very many documents
   has as many edges) are split by window instead: two window hashes mod 2^61 - 1 under
   independent bases, counted with map-side combination and joined back.

Single-context repeats rest on the 64-bit anchor hash, which only chooses places, and a context
hash mod 2^61 - 1. What is joined to the anchors is written first: a join on a hot anchor is split.
Spans come back to their documents by one join. No group of equal strings meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import PolyHash, RollHash, documents, mix, raw_bytes, slices, written

PIECE = 8 << 20  # window starts handled at once; positions within must fit the packed key
PLACE = np.uint64((1 << 24) - 1)


# ---- anchors -------------------------------------------------------------------------------

def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours, by block prefixes and suffixes."""
    n = len(v) - w + 1
    blocks = -(-len(v) // w)
    rows = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    rows[:len(v)] = v
    rows = rows.reshape(blocks, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def anchors(body: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of all texts joined in ``body``: (text, place, first window, last window, hash, context hash).

    Places and windows count from the start of ``body``.
    """
    n, found = len(body), []
    for at in range(0, max(n - length + 1, 0), PIECE):
        part = body[at:min(n, at + PIECE + length - 1)]
        one, two = RollHash(part), PolyHash(part)
        place = np.arange(len(part) - gram + 1)
        grams = mix(one.of(place, place + gram))
        least = _sliding_min((grams & ~PLACE) | place.astype(np.uint64), length - gram + 1)
        chosen = (least & PLACE).astype(np.int64)
        start = np.arange(len(chosen))
        text = np.searchsorted(offs, start + at, side="right") - 1
        ok = start + at + length <= offs[text + 1]
        start, chosen, text = start[ok], chosen[ok], text[ok]
        if not len(start):
            continue
        new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)]))
        first, last = start[new], start[np.concatenate([new[1:], [len(start)]]) - 1]
        p = chosen[new]
        ctx = mix(two.of(first, last + length) ^ mix(((p - first) << 20 | (last - first)).astype(np.uint64)))
        found.append((text[new], p + at, first + at, last + at, grams[p], ctx))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchor_task(length: int, gram: int, keys: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            body, offs = raw_bytes(batch.column("text"))
            text, place, first, last, anchor, ctx = anchors(body, offs, length, gram)
            cols = {"anchor": anchor.view(np.int64), "ctx": ctx.view(np.int64)}
            if keys:
                base, pick = offs[text], pa.array(text)
                cols = {"k": batch.column("k").take(pick), "h": batch.column("h").take(pick)} | cols | {
                    "lo": (first - base).astype(np.int32), "hi": (last - base).astype(np.int32),
                    "p": (place - base).astype(np.int32)}
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in cols.values()], list(cols))

    return run


# ---- contexts and their suffix sort --------------------------------------------------------

def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


CONTEXT_SCHEMA = ("anchor long, k long, h long, lo int, hi int, p int, single boolean, data binary, w1 long, w2 long")


def _context_task(length: int) -> Callable:
    """The bytes of each wanted context, or, of hot anchors, two hashes of each of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            body, offs = raw_bytes(batch.column("text"))
            counts = np.diff(batch.column("anchor").offsets.to_numpy())
            text = np.repeat(np.arange(batch.num_rows), counts)
            cols = {c: _flat(batch.column(c)) for c in ("anchor", "lo", "hi", "p", "single", "hot")}
            names = batch.column("k"), batch.column("h")

            def rows(pick: np.ndarray, lo: np.ndarray, hi: np.ndarray, data: pa.Array, w1: pa.Array, w2: pa.Array) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(cols["anchor"][pick]), *(c.take(pa.array(text[pick])) for c in names), pa.array(lo.astype(np.int32)),
                     pa.array(hi.astype(np.int32)), pa.array(cols["p"][pick]), pa.array(cols["single"][pick]), data, w1, w2],
                    ["anchor", "k", "h", "lo", "hi", "p", "single", "data", "w1", "w2"])

            pick = np.flatnonzero(~cols["hot"].astype(bool))
            if len(pick):
                start, end = offs[text[pick]] + cols["lo"][pick], offs[text[pick]] + cols["hi"][pick] + length
                size = end - start
                at = np.concatenate([[0], np.cumsum(size)])
                if at[-1] >= 1 << 31:
                    raise ValueError("contexts of one slice exceed 2 GB")
                src = np.repeat(start - at[:-1], size) + np.arange(at[-1])
                data = pa.Array.from_buffers(pa.binary(), len(pick), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(body[src].tobytes())])
                none = pa.nulls(len(pick), pa.int64())
                yield rows(pick, cols["lo"][pick], cols["hi"][pick], data, none, none)
            pick = np.flatnonzero(cols["hot"].astype(bool))
            if len(pick):
                many = cols["hi"][pick] - cols["lo"][pick] + 1
                row = np.repeat(pick, many)
                win = cols["lo"][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = offs[text[row]] + win
                w1, w2 = (pa.array(mix(PolyHash(body, base).of(start, start + length)).view(np.int64)) for base in (PolyHash.BASE, PolyHash.BASE2))
                yield rows(row, win, win, pa.nulls(len(row), pa.binary()), w1, w2)

    return run


class SuffixSort:
    """Merge sort of suffixes of one byte array, compared over their first ``length`` bytes."""

    def __init__(self, body: np.ndarray, length: int):
        self.body, self.length, self.hash = body, length, PolyHash(body)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common extension of suffix pairs, up to ``length``: binary search over prefix hashes."""
        same = np.zeros(len(x), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            m = same + step
            ok = m <= self.length
            ok[ok] = self.hash.of(x[ok], x[ok] + m[ok]) == self.hash.of(y[ok], y[ok] + m[ok])
            same[ok] = m[ok]
            step >>= 1
        return same

    def below(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        same = self.common(x, y)
        full = same >= self.length
        at = np.minimum(same, self.length - 1)
        return np.where(full, or_equal, self.body[x + at] < self.body[y + at])

    def sort(self, suffix: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Order (a permutation) that sorts each bucket; ``bucket`` is non-decreasing.

        All buckets merge at once, runs doubling: an element's place in a merged pair of runs is
        its place in its own run plus the elements of the sibling run below it.
        """
        order = np.arange(len(suffix))
        new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
        size = np.diff(np.concatenate([new, [len(bucket)]]))
        base, room = np.repeat(new, size), np.repeat(size, size)
        width = 1
        while len(size) and width < size.max():
            act = np.flatnonzero(room > width)
            i = act - base[act]
            run = i // width
            other = (run ^ 1) * width
            lo = np.minimum(other, room[act])
            first, hi = lo.copy(), np.minimum(other + width, room[act])
            right = (run & 1).astype(bool)
            mine = suffix[order[act]]
            while True:
                live = np.flatnonzero(lo < hi)
                if not len(live):
                    break
                mid = (lo[live] + hi[live]) // 2
                theirs = suffix[order[base[act[live]] + mid]]
                less = self.below(theirs, mine[live], right[live])
                lo[live] = np.where(less, mid + 1, lo[live])
                hi[live] = np.where(less, hi[live], mid)
            place = base[act] + np.minimum(run, run ^ 1) * width + (i - run * width) + (lo - first)
            merged = order.copy()
            merged[place] = order[act]
            order, width = merged, width * 2
        return order

    def equal_neighbours(self, suffix: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """For sorted suffixes: whether each equals the one before it, checked byte by byte."""
        out = np.zeros(len(suffix), bool)
        near = np.flatnonzero(bucket[1:] == bucket[:-1]) + 1
        near = near[self.hash.of(suffix[near], suffix[near] + self.length) == self.hash.of(suffix[near - 1], suffix[near - 1] + self.length)]
        reach = np.arange(self.length)
        for at in range(0, len(near), 1 << 14):
            part = near[at:at + (1 << 14)]
            out[part] = (self.body[suffix[part][:, None] + reach] == self.body[suffix[part - 1][:, None] + reach]).all(axis=1)
        return out


def _repeated_windows(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Runs of windows of single contexts that some other context of the same anchor holds too."""
    body, offs = raw_bytes(batch.column("data"))
    anchor, lo, hi, p, single = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "lo", "hi", "p", "single"))
    lo, hi, p = lo.astype(np.int64), hi.astype(np.int64), p.astype(np.int64)
    group = np.concatenate([[0], np.cumsum(anchor[1:] != anchor[:-1])]) if len(anchor) else np.zeros(0, np.int64)
    many = hi - lo + 1
    row = np.repeat(np.arange(len(lo)), many)
    step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    bucket = group[row] * length + (p[row] - lo[row] - step)  # anchor and offset of the anchor
    suffix = offs[:-1][row] + step
    by = np.argsort(bucket, kind="stable")
    bucket, suffix, row, step = bucket[by], suffix[by], row[by], step[by]
    sizes = np.unique(bucket, return_counts=True)[1]
    keep = np.repeat(sizes > 1, sizes)
    bucket, suffix, row, step = bucket[keep], suffix[keep], row[keep], step[keep]
    job = SuffixSort(body, length)
    order = job.sort(suffix, bucket)
    same = job.equal_neighbours(suffix[order], bucket)
    hit = same.copy()
    hit[:-1] |= same[1:]
    hit = order[hit]
    hit = hit[single[row[hit]]]
    row, step = row[hit], step[hit]
    by = np.lexsort((step, row))
    row, step = row[by], step[by]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)])) if len(row) else np.zeros(0, int)
    end = np.concatenate([new[1:], [len(row)]])[:len(new)] - 1
    pick = pa.array(row[new])
    return pa.RecordBatch.from_arrays([
        batch.column("k").take(pick), batch.column("h").take(pick),
        pa.array((lo[row[new]] + step[new]).astype(np.int32)), pa.array((lo[row[new]] + step[end]).astype(np.int32)),
    ], ["k", "h", "lo", "hi"])


def _sort_task(length: int, flush: int = 1 << 11) -> Callable:
    """Rows come sorted by anchor; whole anchors are sorted, about ``flush`` contexts at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(last: bool) -> Iterator[pa.RecordBatch]:
            rows = pa.concat_batches(held)
            held.clear()
            anchor = rows.column("anchor").to_numpy(zero_copy_only=False)
            cut = len(anchor) if last else int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if (anchor != anchor[-1]).any() else 0
            if cut:
                yield _repeated_windows(rows.slice(0, cut), length)
            if cut < rows.num_rows:
                held.append(rows.slice(cut))

        for batch in batches:
            for at in range(0, batch.num_rows, flush):
                held.append(batch.slice(at, flush))
                if sum(b.num_rows for b in held) >= flush:
                    yield from done(False)
        if held:
            yield from done(True)

    return run


# ---- result --------------------------------------------------------------------------------

def _clean_task(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            body, offs = raw_bytes(batch.column("text"))
            spans = batch.column("spans")
            at, flat = spans.offsets.to_numpy(), _flat(spans).astype(np.int64)
            at = at - at[0]  # a slice keeps the offsets of its batch
            null = spans.is_null().to_numpy(zero_copy_only=False)
            size, removed, runs, digest = [], [], [], []
            for i in range(batch.num_rows):
                mine = memoryview(body[offs[i]:offs[i + 1]])
                sha, n, gone, pieces = hashlib.sha256(), len(mine), 0, 0
                done = 0
                if not null[i] and at[i + 1] > at[i]:
                    own = np.sort(flat[at[i]:at[i + 1]])
                    lo, end = own >> 32, np.maximum.accumulate((own & 0xFFFFFFFF) + length)
                    new = np.flatnonzero(np.concatenate([[True], lo[1:] > end[:-1]]))
                    for a, b in zip(lo[new].tolist(), end[np.concatenate([new[1:], [len(lo)]]) - 1].tolist()):
                        sha.update(mine[done:a])
                        gone, done, pieces = gone + b - a, b, pieces + 1
                sha.update(mine[done:])
                size.append(n)
                removed.append(gone)
                runs.append(pieces)
                digest.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def _spanned(lo: str | F.Column = "lo", hi: str | F.Column = "hi") -> list:
    return ["k", "h", (F.shiftleft(F.col(lo).cast("long"), 32).bitwiseOR(F.col(hi).cast("long"))).alias("span")]


def suffix_dedup(docs: DataFrame, *, length: int = 200, gram: int = 48, group: int = 8192) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Every byte covered by a ``length``-byte string that also starts anywhere else (same document
    included, overlaps count) is removed, judged on the input. Null and short texts keep all
    they have (a null text has no bytes); rows that repeat a ``doc_id`` or have none are
    documents of their own, and a repeated row's text is a repeat like any other. An empty table
    gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    null = F.col("doc_id").isNull()
    rows = documents(docs).select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("k"),
                                  F.xxhash64("text", null).alias("h"), "text")
    counted = (rows.select("text").mapInArrow(_anchor_task(length, gram, False), "anchor long, ctx long")
               .groupBy("anchor").agg(F.count("*").alias("n"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1"))
               .filter("n > 1").select("anchor", (F.col("c0") != F.col("c1")).alias("multi")))
    counted = written(counted, "suffix-counted")
    met = (rows.select("k", "h", "text")
           .mapInArrow(_anchor_task(length, gram, True), "k long, h long, anchor long, ctx long, lo int, hi int, p int")
           .join(counted, "anchor"))
    met = written(met, "suffix-anchors")
    multi = met.filter("multi").drop("multi")

    contexts = multi.groupBy("anchor", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("k", "h", "lo", "hi", "p")).alias("at"))
    contexts = written(contexts.select("anchor", "ctx", "at.*", (F.col("n") == 1).alias("single")), "suffix-contexts")
    size = contexts.groupBy("anchor").agg(F.count("*").alias("c"))
    wanted = contexts.join(size, "anchor").withColumn("hot", F.col("c") > group)

    repeated = [met.filter("not multi").select(*_spanned()),
                multi.join(contexts.filter("not single").select("anchor", "ctx"), ["anchor", "ctx"]).select(*_spanned())]
    texts = rows.select("k", "h", "doc_id", "text")
    fields = ["anchor", "lo", "hi", "p", "single", "hot"]
    lists = wanted.groupBy("k", "h").agg(F.collect_list(F.struct(*fields)).alias("c"))
    held = written(texts.join(lists, ["k", "h"]).select("k", "h", "text", *(F.col(f"c.{x}").alias(x) for x in fields))
                   .mapInArrow(_context_task(length), CONTEXT_SCHEMA), "suffix-bytes")

    cold = held.filter("w1 is null").drop("w1", "w2").repartition("anchor").sortWithinPartitions("anchor")
    repeated.append(cold.mapInArrow(_sort_task(length), "k long, h long, lo int, hi int").select(*_spanned()))
    windows = held.filter("w1 is not null").select("k", "h", "lo", "single", "w1", "w2")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    repeated.append(windows.filter("single").join(twice, ["w1", "w2"]).select(*_spanned("lo", "lo")))

    spans = repeated[0]
    for more in repeated[1:]:
        spans = spans.unionByName(more)
    spans = spans.groupBy("k", "h").agg(F.collect_set("span").alias("spans"))
    return (texts.join(spans, ["k", "h"], "left").select("doc_id", "text", "spans")
            .mapInArrow(_clean_task(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
