"""Benchmark decontamination: passages within a word edit distance of a benchmark item.

A text's words (lower case, ASCII letters and digits and all characters beyond ASCII) are its
symbols. Items and documents are cut into windows of the item's size class, one at every word.
A CGK walk embeds a window: at each step it emits the symbol it stands on and moves on by a
random bit that depends on step and symbol, so that windows a few edits apart emit strings a few
places apart. A repetition draws its own bits and samples a few steps as a bucket key; a document
window that shares a key with an item window is a candidate, and the item's whole alignment there
is verified by exact edit distance. An item gets as many repetitions as its length needs for the
target recall, found by trying the walks on random items with edits at the limit. Items too short
for an edit sample only steps that cannot leave the window, so that one repetition finds them all.

All walks of a text run at once. Walks that meet at the same word in the same step stay
together, so they are merged as they meet: what is left to walk falls off quickly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import mix, slices, words

MATCH_SCHEMA = "doc_id long, item_id long, distance int, item_words int, at_word int"


# ---- embedding -----------------------------------------------------------------------------

def _walk(symbols: np.ndarray, n: int, seed: int, steps: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Bucket key of the window at each of the first ``n`` symbols: a sum over the sampled steps
    of the symbol there times the step's factor. ``symbols`` is padded beyond ``n``."""
    bits = mix(symbols ^ np.uint64(seed))
    place, key = np.arange(n), np.zeros(n, np.uint64)
    merged: list[tuple[np.ndarray, np.ndarray]] = []
    last, sampled = int(steps.max()), dict(zip(steps.tolist(), factors))
    for t in range(last + 1):
        if t in sampled:
            key += symbols[place] * sampled[t]
        if t == last:
            break
        place = place + ((bits[place] >> np.uint64(t)) & np.uint64(1)).astype(np.int64)
        if t in (3, 7, 15, 31):
            new = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
            merged.append((key, np.cumsum(new) - 1))
            place = place[new]
            key = np.zeros(len(place), np.uint64)
    for above, index in reversed(merged):
        key = above + key[index] if len(index) else above
    return key


def size_class(n: int, most: int = 8) -> int:
    """Window size of an item of ``n`` words: the largest power of two up to ``n`` and ``most``."""
    return min(most, 1 << (max(n, 1).bit_length() - 1))


def _draws(size: int, samples: int, exact: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Seed, sampled steps and their factors of each repetition of a size class."""
    rng = np.random.default_rng([20_240_607, size, exact])
    while True:
        seed = int(rng.integers(1, 2**63))
        steps = np.arange(size) if exact else np.sort(rng.choice(2 * size, min(samples, 2 * size), replace=False))
        yield seed, steps, rng.integers(1, 2**63, len(steps)).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _trials(n: int, edits: int, size: int, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Random items of ``n`` words, and each with ``edits`` edits and other words after it (one a row)."""
    rng = np.random.default_rng([7, n, edits])
    item = rng.integers(1, 2**63, (many, n)).astype(np.uint64)
    there = np.zeros((many, n + edits + 2 * size + 1), np.uint64)
    for k in range(many):
        w = item[k].tolist()
        for _ in range(edits):
            at, kind = int(rng.integers(len(w))), int(rng.integers(3))
            w[at:at + (kind > 0)] = [int(rng.integers(1, 2**63))] * (kind < 2)
        there[k, :len(w)] = w
        there[k, len(w):] = rng.integers(1, 2**63, there.shape[1] - len(w))
    return np.concatenate([item, np.zeros((many, 2 * size + 1), np.uint64)], axis=1), there


@cache
def repetitions_for(n: int, edits: float, samples: int, recall: float, many: int = 1000) -> int:
    """Repetitions that find ``recall`` of random items of ``n`` words with as many edits as are allowed."""
    limit, size = int(edits * n), size_class(n)
    if not limit:
        return 1
    item, there = _trials(n, limit, size, many)
    for done, (seed, steps, factors) in enumerate(_draws(size, samples, False)):
        if len(item) <= (1 - recall) * many:
            return done
        if done == 2000:
            raise ValueError(f"no recall of {recall} for items of {n} words with {limit} edits")
        keys = []
        for rows, windows in ((item, n - size + 1), (there, there.shape[1] - 2 * size)):
            pad = np.zeros(2 * size + 1, np.uint64)
            keys.append(_walk(np.concatenate([rows.ravel(), pad]), rows.size, seed, steps, factors).reshape(rows.shape)[:, :windows])
        missed = ~(keys[0][:, :, None] == keys[1][:, None, :]).any(axis=(1, 2))
        item, there = item[missed], there[missed]


class ItemIndex:
    """Bucket keys of all windows of a block of items, for each repetition and size class."""

    def __init__(self, items: list[tuple[int | None, str]], repetitions: dict[int, int], samples: int, edits: float):
        texts = pc.utf8_lower(pa.array([t or "" for _, t in items], pa.string()))
        h, first, _, _ = words(texts, alnum=True)
        self.edits = edits
        self.ids = [i for i, _ in items]
        self.symbols = [h[a:b] for a, b in zip(first, first[1:])]
        # which top 12 bits of a hash an item's words have, for a quick bound before the exact check
        self.sieves = np.zeros((len(items), 4096), bool)
        for k, x in enumerate(self.symbols):
            self.sieves[k, (x >> np.uint64(52)).astype(np.int64)] = True
        self.tables = []
        exact = [int(edits * len(s)) == 0 for s in self.symbols]
        for size, one in sorted({(size_class(len(s)), e) for s, e in zip(self.symbols, exact) if len(s)}):
            every = [k for k, s in enumerate(self.symbols) if len(s) and (size_class(len(s)), exact[k]) == (size, one)]
            pad = np.zeros(2 * size + 1, np.uint64)
            for done, (seed, steps, factors) in enumerate(_draws(size, samples, one)):
                mine = [k for k in every if repetitions[len(self.symbols[k])] > done]
                if not mine:
                    break
                joined = np.concatenate([x for k in mine for x in (self.symbols[k], pad)])
                starts = np.cumsum([0] + [len(self.symbols[k]) + len(pad) for k in mine])
                keys = _walk(np.concatenate([joined, pad]), len(joined), seed, steps, factors)
                own = [(keys[starts[j] + o], k, o) for j, k in enumerate(mine) for o in range(len(self.symbols[k]) - size + 1)]
                own.sort()
                key = np.asarray([x[0] for x in own], np.uint64)
                sieve = np.zeros(1 << 20, bool)
                sieve[(mix(key) >> np.uint64(44)).astype(np.int64)] = True
                self.tables.append((size, seed, steps, factors, key, np.asarray([x[1] for x in own]), np.asarray([x[2] for x in own]), sieve))

    def candidates(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct rows of (place in ``h`` where an item would begin, item, text of the window)."""
        n, found, items, lead = len(h), [], len(self.symbols), max((len(s) for s in self.symbols), default=0)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        room = first[1:][text] - np.arange(n)
        for size, seed, steps, factors, key, item, offset, sieve in self.tables:
            got = _walk(np.concatenate([h, np.zeros(2 * size + 1, np.uint64)]), n, seed, steps, factors)
            at = np.flatnonzero(sieve[(mix(got) >> np.uint64(44)).astype(np.int64)])
            at = at[room[at] >= size]
            lo, hi = np.searchsorted(key, got[at], "left"), np.searchsorted(key, got[at], "right")
            many = hi - lo
            row = np.repeat(np.arange(len(at)), many)
            slot = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            # one number a candidate: the item's begin counts from ``lead`` words before its text
            begin = at[row] - offset[slot] - first[text[at[row]]] + lead
            found.append((text[at[row]] * (n + lead + 1) + begin) * items + item[slot])
        where, item = np.divmod(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64), max(items, 1))
        text, begin = np.divmod(where, n + lead + 1)
        return np.stack([begin - lead + first[text], item, text])

    def matches(self, h: np.ndarray, first: np.ndarray, at: np.ndarray, item: np.ndarray,
                text: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Exact check of candidates: yields (text, item, distance, first word) within the limit."""
        for k in np.unique(item):
            mine, symbols = np.flatnonzero(item == k), self.symbols[k]
            n = len(symbols)
            limit = int(self.edits * n)
            for part in np.array_split(mine, -(-len(mine) // 2048)):
                left = at[part] - limit
                reach = left[:, None] + np.arange(n + 2 * limit)
                inside = (reach >= first[text[part]][:, None]) & (reach < first[text[part] + 1][:, None])
                there = np.where(inside, h[np.clip(reach, 0, len(h) - 1)], np.uint64(0))
                # at most ``limit`` edits leave all but ``limit`` of the item's words in the stretch
                near = (self.sieves[k][(there >> np.uint64(52)).astype(np.int64)] & inside).sum(axis=1) >= n - limit
                part, there, inside = part[near], there[near], inside[near]
                if not len(part):
                    continue
                dist = _edit_distances(symbols, there, inside)
                for j in np.flatnonzero(dist <= limit):
                    yield int(text[part[j]]), int(k), int(dist[j]), int(max(0, at[part[j]] - first[text[part[j]]]))


def _edit_distances(item: np.ndarray, there: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Least edit distance of ``item`` to any stretch of each row of ``there``."""
    rows, width = there.shape
    step = np.arange(width + 1)
    dist = np.zeros((rows, width + 1), np.int64)
    for k, symbol in enumerate(item):
        new = np.empty_like(dist)
        new[:, 0] = k + 1
        new[:, 1:] = np.minimum(dist[:, :-1] + ~((there == symbol) & inside), dist[:, 1:] + 1)
        dist = np.minimum.accumulate(new - step, axis=1) + step
    return dist.min(axis=1)


# ---- Spark jobs ----------------------------------------------------------------------------

def _repetitions(items: list, least: int, samples: int, edits: float, recall: float, most: int = 40) -> dict[int, int]:
    """Repetitions for each length of the items; those of more than ``most`` words, with more
    windows for the same share of edits, take what ``most`` words take."""
    first = words(pc.utf8_lower(pa.array([t or "" for _, t in items], pa.string())), alnum=True)[1]
    sizes = {int(n) for n in np.unique(np.diff(first)) if n}
    return {n: max(least if int(edits * n) else 1, repetitions_for(min(n, most), edits, samples, recall)) for n in sizes}


def _task(items: list, repetitions: dict[int, int], samples: int, edits: float, keep_clean: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(items, repetitions, samples, edits)
        for batch in slices(batches):
            lower = pc.utf8_lower(pc.fill_null(batch.column("text"), ""))
            h, first, _, _ = words(lower, alnum=True)
            best: dict[tuple[int, int], tuple[int, int]] = {}
            for t, k, d, w in index.matches(h, first, *index.candidates(h, first)):
                if (d, w) < best.get((t, k), (1 << 30, 0)):
                    best[t, k] = (d, w)
            if keep_clean:
                hit = np.zeros(batch.num_rows, bool)
                hit[[t for t, _ in best]] = True
                yield batch.filter(pa.array(~hit))
            elif best:
                rows = sorted((t, k, *v) for (t, k), v in best.items())
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array([r[0] for r in rows])),
                    pa.array([index.ids[r[1]] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int32()),
                    pa.array([len(index.symbols[r[1]]) for r in rows], pa.int32()),
                    pa.array([r[3] for r in rows], pa.int32())],
                    ["doc_id", "item_id", "distance", "item_words", "at_word"])

    return run


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list]:
    """The items in blocks of about ``block_bytes``: the stated query set, held by every task a
    block at a time, whatever its size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    n = -(-size // block_bytes)
    for b in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield sorted(((r.item_id, r.text) for r in part.toLocalIterator()), key=repr)


def find_benchmark_passages(docs: DataFrame, benchmark: DataFrame, *, edits: float = 0.2, repetitions: int = 8,
                            samples: int = 5, recall: float = 0.995, block_bytes: int = 8 << 20) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id, item_id, distance,
    item_words, at_word`` (its best alignment: least distance, then the earliest).

    An item is found where some stretch of the text is within ``edits`` times its words of word
    edit distance, with a probability of at least ``recall`` for edits at that limit (items get
    ``repetitions`` walks, or more as their length needs). Null and empty texts and items match nothing; a repeated or null ``doc_id``
    is reported for each of its rows; a repeated item counts once; an item of fewer than five
    words must occur exactly. An empty table on either side gives no rows. Only ``doc_id``,
    ``item_id`` and the two ``text`` columns are read.
    """
    spark, out = docs.sparkSession, None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for items in _blocks(benchmark, block_bytes):
        found = rows.mapInArrow(_task(items, _repetitions(items, repetitions, samples, edits, recall), samples, edits, False), MATCH_SCHEMA)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], MATCH_SCHEMA) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, edits: float = 0.2, repetitions: int = 8,
                      samples: int = 5, recall: float = 0.995, block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item is found."""
    for items in _blocks(benchmark, block_bytes):
        docs = docs.mapInArrow(_task(items, _repetitions(items, repetitions, samples, edits, recall), samples, edits, True), docs.schema)
    return docs
