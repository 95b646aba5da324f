"""Hidden Markov language model: Baum-Welch over all training documents, exact sequence likelihood.

Documents are turned once into written blocks: the words of a block are coded against the block's
own dictionary, so that counts meet words once a block, never once a token. Word counts come from
one exchange of (block, word) pairs; nothing of the vocabulary is collected or broadcast.

The hidden states emit word classes, and a class emits its words by their base probability:

    P(word | state) = P(class | state) * base(word) / base(class)

A class is a hash of the word (``classes`` of them, and one for the end of a text), so the model
has ``classes x states`` emission weights whatever the vocabulary, a proven bound for what a task
sends and the driver holds. With one state the model is the base. A word that training never saw
keeps its base probability in every state. A text starts in a silent state drawn from ``start``.

Each Baum-Welch round is one pass: tasks run the scaled forward and backward recursions over their
blocks, all texts of a block abreast, and send expected counts per class, which Spark sums. Texts
longer than ``SEGMENT`` tokens are cut; the transfer matrix of each piece (the recursion started
from every state) carries the exact vector from piece to piece, so a very long text costs as many
steps as one piece and nothing is approximated.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import raw_bytes, slices, written

STATES = 8
CLASSES = 1 << 15
ROUNDS = 6
BLOCK_BYTES = 16 << 20  # text of one block: bounds what a task holds at once
SEGMENT = 4096  # tokens of a piece of a long text
PRIOR = 2.0  # tokens that pull the states' weights of a class to their common mean
FIXED = 1 << 20  # expected counts are summed as integers: the order of tasks does not matter

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Model:
    """``lift[class, state]`` is P(class | state) / base(class); rows ``classes`` and ``classes`` + 1
    are the end of a text and unseen words. ``tokens``: N, ``types``: V, ``ends``: texts learnt from."""
    lift: np.ndarray
    step: np.ndarray
    start: np.ndarray
    tokens: int
    types: int
    ends: int
    log_likelihood: list[float]


# ---- blocks --------------------------------------------------------------------------------

def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of every word, the dictionary, and the number of words of each text."""
    body, offs = raw_bytes(texts)
    body = _LOWER[body]
    n = len(body)
    inside = ~_SPACE[body]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    at = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    flat = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(body[inside].tobytes())])
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.diff(np.searchsorted(start, offs))


def _block(number: int, doc_ids: pa.Array, held: pa.Array, texts: pa.Array, classes: int) -> pa.RecordBatch:
    codes, words, lengths = _words(texts)
    learnt = np.repeat(~held.to_numpy(zero_copy_only=False), lengths)
    words = words.to_pylist()
    counts = np.bincount(codes[learnt], minlength=len(words)).astype(np.int64)
    kinds = np.fromiter((zlib.crc32(w) % classes for w in words), np.uint16, len(words))
    body, offs = raw_bytes(texts)
    raw = body.tobytes()
    seeds = [zlib.crc32(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
    one = {
        "block": pa.array([number], pa.int64()), "doc_ids": pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())),
        "held": pa.array([held.to_pylist()], pa.list_(pa.bool_())), "lengths": pa.array([lengths.tolist()], pa.list_(pa.int64())),
        "seeds": pa.array([seeds], pa.list_(pa.int64())), "codes": pa.array([codes.astype("<u4").tobytes()], pa.binary()),
        "kinds": pa.array([kinds.astype("<u2").tobytes()], pa.binary()),
        "words": pa.array([[w.decode() for w in words]], pa.list_(pa.string())), "counts": pa.array([counts.tolist()], pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_arrays(list(one.values()), list(one))


BLOCK_SCHEMA = ("block long, doc_ids array<long>, held array<boolean>, lengths array<long>, seeds array<long>, "
                "codes binary, kinds binary, words array<string>, counts array<long>")


def _blocks_task(block_bytes: int, classes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def made() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            columns = [whole.column(c).combine_chunks() for c in ("doc_id", "held", "text")]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            return _block(number, *columns, classes)

        for batch in slices(batches, limit=block_bytes):
            n = batch.column("text").nbytes
            if held and size + n > block_bytes:
                yield made()
                number, held, size = number + 1, [], 0
            held.append(batch)
            size += n
        if held:
            yield made()

    return run


def blocks_of(docs: DataFrame, held: Column, block_bytes: int, classes: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return written(rows.mapInArrow(_blocks_task(block_bytes, classes), BLOCK_SCHEMA), "hmm-blocks")


# ---- recursions ----------------------------------------------------------------------------

class Lattice:
    """The tokens of many texts laid out step by step: step t of all pieces that have one is
    contiguous, longest pieces first. ``piece`` is the length beyond which a text is cut."""

    def __init__(self, classes: np.ndarray, lengths: np.ndarray, piece: int = SEGMENT):
        pieces = np.maximum(-(-lengths // piece), 0)
        text = np.repeat(np.arange(len(lengths)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(lengths[text] - nth * piece, piece)
        begin = (np.cumsum(lengths) - lengths)[text] + nth * piece
        order = np.argsort(-size, kind="stable")
        self.text, self.nth, self.size = text[order], nth[order], size[order]
        self.last = self.nth == pieces[self.text] - 1
        self.many = np.flatnonzero(pieces[self.text] > 1)  # pieces of texts that were cut
        steps = int(self.size[0]) if len(order) else 0
        self.live = len(order) - np.searchsorted(self.size[::-1], np.arange(steps), side="right")  # pieces longer than t
        self.at = np.concatenate([[0], np.cumsum(self.live)])
        total = int(self.at[-1])
        rank = np.repeat(np.arange(len(order)), self.size)
        place = np.arange(total) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.tokens = np.empty(total, classes.dtype)
        self.tokens[self.at[place] + rank] = classes[begin[order][rank] + place]

    def step(self, t: int) -> np.ndarray:
        return self.tokens[self.at[t]:self.at[t + 1]]

    def _chains(self) -> list[np.ndarray]:
        """For each cut text, its pieces in order (places within ``many``)."""
        if not len(self.many):
            return []
        order = np.lexsort((self.nth[self.many], self.text[self.many]))
        cut = np.flatnonzero(np.diff(self.text[self.many][order])) + 1
        return np.split(order, cut)

    def transfers(self, lift: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Of each piece of a cut text, the recursion from every state, scaled."""
        k = len(step)
        x = np.tile(np.eye(k, dtype=step.dtype), (len(self.many), 1, 1))
        for t in range(len(self.live) if len(self.many) else 0):
            n = int(np.searchsorted(self.many, self.live[t]))  # cut pieces still running come first
            if not n:
                break
            y = (x[:n].reshape(-1, k) @ step).reshape(n, k, k) * lift[self.step(t)[self.many[:n]]][:, None, :]
            x[:n] = y / y.sum(axis=(1, 2), keepdims=True)
        return x

    def entries(self, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
        """State weights before the first token of each piece."""
        entry = np.tile(start, (len(self.size), 1))
        for chain in self._chains():
            v = start
            for i in chain:
                entry[self.many[i]] = v
                v = v @ moves[i]
                v = v / v.sum()
        return entry

    def exits(self, moves: np.ndarray) -> np.ndarray:
        """Backward weights after the last token of each piece."""
        out = np.ones((len(self.size), moves.shape[-1]), moves.dtype)
        for chain in self._chains():
            v = np.ones(moves.shape[-1], moves.dtype)
            for i in chain[::-1]:
                out[self.many[i]] = v
                v = moves[i] @ v
                v = v / v.sum()
        return out

    def forward(self, lift: np.ndarray, step: np.ndarray, entry: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
        """Natural log likelihood of each piece; ``keep`` takes the scaled weights of every token."""
        a, out = entry, np.zeros(len(self.size))
        for t, n in enumerate(self.live.tolist()):
            a = (a[:n] @ step) * lift[self.step(t)]
            s = a.sum(axis=1, keepdims=True)
            a /= s
            out[:n] += np.log(s[:, 0], dtype=np.float64)
            if keep is not None:
                keep[self.at[t]:self.at[t + 1]] = a
        return out


def log_likelihoods(classes: np.ndarray, lengths: np.ndarray, lift: np.ndarray, step: np.ndarray, start: np.ndarray, piece: int = SEGMENT) -> np.ndarray:
    """Natural log of P(text) / base(text) of each text, by the scaled forward recursion."""
    grid = Lattice(classes, lengths, piece)
    found = grid.forward(lift, step, grid.entries(grid.transfers(lift, step), start))
    return np.bincount(grid.text, weights=found, minlength=len(lengths))


def expected_counts(classes: np.ndarray, lengths: np.ndarray, lift: np.ndarray, step: np.ndarray, start: np.ndarray,
                    piece: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected emissions (class, state), moves (state, state), starts, and the log likelihood."""
    k, grid = len(step), Lattice(classes, lengths, piece)
    moves = grid.transfers(lift, step)
    entry = grid.entries(moves, start)
    seen = np.empty((len(grid.tokens), k), lift.dtype)
    fit = float(grid.forward(lift, step, entry, seen).sum())
    exit_ = grid.exits(moves)
    b, pairs = exit_, np.zeros((k, k))
    done = 0  # pieces whose backward weights run already
    for t in range(len(grid.live) - 1, -1, -1):
        lo, n = grid.at[t], int(grid.live[t])
        now = seen[lo:lo + n]
        if n > done:  # pieces that end here
            begin = exit_[done:n] / (now[done:] * exit_[done:n]).sum(axis=1, keepdims=True)
            b = begin if not done else np.concatenate([b, begin])
            done = n
        u = lift[grid.step(t)] * b
        now *= b
        before = seen[grid.at[t - 1]:grid.at[t - 1] + n] if t else entry
        u /= ((before @ step) * u).sum(axis=1, keepdims=True)
        pairs += before.T @ u
        b = u @ step.T
    first = grid.nth == 0
    starts = (entry[first] * b[first]).sum(axis=0) if done else np.zeros(k)
    emitted = np.stack([np.bincount(grid.tokens, weights=seen[:, s], minlength=len(lift)) for s in range(k)], axis=1)
    return emitted, pairs * step, starts, fit


# ---- Baum-Welch ----------------------------------------------------------------------------

def _sequences(codes: bytes, kinds: bytes, lengths: np.ndarray, end: int) -> np.ndarray:
    """Class of every token of all texts, each followed by its end."""
    of = np.frombuffer(kinds, "<u2")[np.frombuffer(codes, "<u4")]
    out = np.full(len(of) + len(lengths), end, np.uint16)
    out[np.arange(len(of)) + np.repeat(np.arange(len(lengths)), lengths)] = of
    return out


def _counts_task(classes: int, states: int, model: tuple[np.ndarray, np.ndarray, np.ndarray] | None, piece: int) -> Callable:
    """Rows ``id`` and a count per state: classes and the end, then moves from each state, starts,
    log likelihood. Without a model every text is in one state, by a hash of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes + 3 + states, states))
        for batch in batches:
            for codes, kinds, lengths, held, seeds in zip(*(batch.column(c) for c in ("codes", "kinds", "lengths", "held", "seeds"))):
                lengths, learnt = np.asarray(lengths.as_py(), np.int64), ~np.asarray(held.as_py(), bool)
                found = _sequences(codes.as_py(), kinds.as_py(), lengths, classes)[np.repeat(learnt, lengths + 1)]
                lengths = lengths[learnt] + 1
                if not len(lengths):
                    continue
                if model is None:
                    state = np.asarray(seeds.as_py(), np.int64)[learnt] % states
                    np.add.at(total, (found, np.repeat(state, lengths)), 1)
                    continue
                emitted, pairs, starts, fit = expected_counts(found, lengths, *model, piece=piece)
                total[:classes + 1] += emitted[:classes + 1]
                total[classes + 1:classes + 1 + states] += pairs
                total[classes + 1 + states] += starts
                total[classes + 2 + states, 0] += fit
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array(np.rint(total[some, s] * FIXED).astype(np.int64)) for s in range(states))],
                                         ["id", *(f"s{s}" for s in range(states))])

    return run


def _summed(blocks: DataFrame, classes: int, states: int, model: tuple | None, piece: int) -> np.ndarray:
    """The counts of all tasks: at most ``classes`` + ``states`` + 3 rows reach the driver."""
    parts = blocks.select("codes", "kinds", "lengths", "held", "seeds").mapInArrow(
        _counts_task(classes, states, model, piece), "id long, " + ", ".join(f"s{s} long" for s in range(states)))
    out = np.zeros((classes + 3 + states, states))
    for row in parts.groupBy("id").agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in range(states)]).collect():
        out[row[0]] = row[1:]
    return out / FIXED


def _lift(emitted: np.ndarray, base: np.ndarray, prior: float) -> np.ndarray:
    """P(class | state) / base(class) from expected counts; ``base`` sums to the known mass."""
    known, share = base.sum(), emitted.sum(axis=0)
    if not known or not share.sum():
        return np.ones((len(base) + 1, emitted.shape[1]))
    share = np.maximum(share / share.sum(), 1e-12)
    lift = (emitted + prior * share) / ((emitted.sum(axis=1, keepdims=True) + prior) * share)
    lift /= (base @ lift) / known
    return np.concatenate([lift, np.ones((1, emitted.shape[1]))])


def word_counts(blocks: DataFrame, classes: int) -> DataFrame:
    """``block, code, c, kind, first``: the training count of every word of every block; ``first``
    marks one row of each distinct word. A word has one row a block, so a frequent one as many as
    there are blocks."""
    rows = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w"))
    rows = rows.select("block", "code", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    same = Window.partitionBy("word")
    return written(rows.select("block", "code", F.sum("n").over(same).alias("c"), (F.crc32(F.col("word").cast("binary")) % classes).cast("int").alias("kind"),
                               (F.min("block").over(same) == F.col("block")).alias("first")), "hmm-words")


def train(blocks: DataFrame, counts: DataFrame, *, states: int = STATES, classes: int = CLASSES, rounds: int = ROUNDS,
          prior: float = PRIOR, piece: int = SEGMENT) -> Model:
    """Baum-Welch: ``rounds`` passes over all training texts of ``blocks``."""
    summed = _summed(blocks, classes, states, None, piece)
    ends = round(summed[classes].sum())
    known = counts.filter("first AND c > 0").groupBy("kind").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    size, types = np.zeros(classes + 1), int(sum(r["v"] for r in known)) + (ends > 0)
    tokens = int(sum(r["c"] for r in known)) + ends
    for r in known:
        size[r["kind"]] = r["c"] + r["v"]
    size[classes] = ends + 1 if ends else 0
    base = size / (tokens + types + 1)
    step = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    start, fits = np.full(states, 1 / states), []
    for _ in range(rounds):
        lift = _lift(summed[:classes + 1], base, prior)
        summed = _summed(blocks, classes, states, tuple(x.astype(np.float32) for x in (lift, step, start)), piece)
        fits.append(float(summed[classes + 2 + states, 0]))
        moves = summed[classes + 1:classes + 1 + states] + 1
        step, start = moves / moves.sum(axis=1, keepdims=True), summed[classes + 1 + states] + 1
        start = start / start.sum()
    return Model(_lift(summed[:classes + 1], base, prior), step, start, tokens, types, ends, fits)


# ---- scores --------------------------------------------------------------------------------

SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score_task(model: Model, classes: int, piece: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in SCORE_SCHEMA.split(", ")}
        for row in left.to_pylist():
            lengths = np.asarray(row["lengths"], np.int64)
            codes, kinds = np.frombuffer(row["codes"], "<u4"), np.frombuffer(row["kinds"], "<u2").copy()
            c = np.zeros(len(kinds), np.int64)
            c[right.column("code").to_numpy()] = right.column("c").to_numpy()
            kinds[c == 0] = classes + 1
            all_types = np.log10(model.tokens + model.types + 1)
            text = np.repeat(np.arange(len(lengths)), lengths)
            base = np.bincount(text, weights=(np.log10(c + 1) - all_types)[codes], minlength=len(lengths)) + np.log10(model.ends + 1) - all_types
            known = np.bincount(text, weights=(c > 0)[codes], minlength=len(lengths)).astype(np.int64) + (model.ends > 0)
            found = _sequences(codes.tobytes(), kinds.tobytes(), lengths, classes if model.ends else classes + 1)
            score = base + log_likelihoods(found, lengths + 1, model.lift, model.step, model.start, piece) / np.log(10)
            for name, values in zip(out, (row["doc_ids"], row["held"], (lengths + 1).tolist(), known.tolist(), [model.tokens] * len(lengths), base.tolist(), score.tolist())):
                out[name] += values
        kinds_of = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({name: pa.array(v, k) for (name, v), k in zip(out.items(), kinds_of)})

    return run


def score(blocks: DataFrame, counts: DataFrame, model: Model, classes: int = CLASSES, piece: int = SEGMENT) -> DataFrame:
    """Every text of ``blocks``: its block meets the counts of its own words, and is scored whole."""
    left = blocks.select("block", "doc_ids", "held", "lengths", "codes", "kinds").groupBy("block")
    right = counts.select("block", "code", "c").groupBy("block")
    return left.cogroup(right).applyInArrow(_score_task(model, classes, piece), SCORE_SCHEMA)


def hmm_scores(docs: DataFrame, held: Column, *, states: int = STATES, classes: int = CLASSES, rounds: int = ROUNDS,
               block_bytes: int = BLOCK_BYTES, piece: int = SEGMENT) -> DataFrame:
    """Per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from all documents where ``held`` is not true, and scores all: ``score`` is the
    log10 probability of the whole text and its end. Words are runs of characters other than ASCII
    white space, A-Z in lower case; the end counts as a token. ``base_score`` is the add-one unigram
    score. Null and empty texts are their end alone. A null ``doc_id`` is learnt from. Equal rows
    count and score each for themselves. Without a training document every score is 0; an empty
    table gives no rows. ``classes`` is at most 65,534. Only ``doc_id`` and ``text`` are read.
    """
    blocks = blocks_of(docs, held, block_bytes, classes)
    counts = word_counts(blocks, classes)
    return score(blocks, counts, train(blocks, counts, states=states, classes=classes, rounds=rounds, piece=piece), classes, piece)
