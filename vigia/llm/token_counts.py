"""Edit-aware token counts: a segment tree of pre-tokens per document.

A text's pre-tokens (the pieces its tokenizer's pattern makes; merges never cross them) are
grouped into leaves of ``LEAF``; a tree over the leaves keeps subtree sums of characters and
tokens. The pattern scans forward, never looks behind, and looks at most one character past a
piece, so an edit can only change pieces from the leaf that holds the character before it, and
scanning from there gives the new pieces up to the first old leaf end, beyond the edit, that is
a piece end again. Only that stretch is encoded anew; its leaves and the sums above them change.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import slices

LEAF = 64
EDITS = "array<struct<start:int,stop:int,text:string>>"


class PieceCounter:
    """Token counts of pre-tokens, each distinct piece encoded once (up to ``keep`` are kept)."""

    _made: dict[tuple[str, str], PieceCounter] = {}

    def __init__(self, path: str, pattern: str, keep: int = 1_000_000):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.keep, self.known = keep, {}

    @classmethod
    def of(cls, path: str, pattern: str) -> PieceCounter:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def count(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > self.keep:
            known.clear()
        out = []
        for p in pieces:
            n = known.get(p)
            if n is None:
                n = len(self.encoding.encode_ordinary(p))
                if len(p) <= 64:
                    known[p] = n
            out.append(n)
        return out


class SegmentTree:
    """Sums of characters and tokens over leaves; a leaf keeps its slot, an emptied one holds 0."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.size = 1 << max(len(chars) - 1, 0).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        self.chars[self.size:self.size + len(chars)] = map(int, chars)
        self.tokens[self.size:self.size + len(chars)] = map(int, tokens)
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, that leaf's first character)."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.size
        self.chars[i], self.tokens[i] = chars, tokens
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]


class CountedText:
    """A text with its tree; ``edit`` replaces a range and returns the characters encoded anew."""

    def __init__(self, text: str, counter: PieceCounter):
        self.text, self.counter = text, counter
        pieces = counter.pattern.findall(text)
        tokens = np.asarray(counter.count(pieces), np.int64)
        chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.arange(0, len(pieces), LEAF)
        self.total = int(tokens.sum())
        self._leaves = (np.add.reduceat(chars, starts), np.add.reduceat(tokens, starts)) if len(pieces) else (np.zeros(1, int),) * 2
        self._tree: SegmentTree | None = None

    @property
    def tree(self) -> SegmentTree:
        if self._tree is None:
            self._tree = SegmentTree(*self._leaves)
        return self._tree

    @property
    def n_tokens(self) -> int:
        return self._tree.tokens[1] if self._tree else self.total

    def edit(self, start: int, stop: int, text: str) -> int:
        tree, n = self.tree, len(self.text)
        start = min(max(start, 0), n)
        stop = min(max(stop, start), n)
        # the cut before a run of white space may depend on what follows the run
        cut = len(self.text[:start].rstrip()) if start and self.text[start - 1].isspace() else start
        leaf, begin = tree.find(max(cut - 1, 0)) if n else (0, 0)
        grow = len(text) - (stop - start)
        self.text = self.text[:start] + text + self.text[stop:]
        settled = start + len(text)  # old and new text agree from here on
        last, end = leaf, begin + tree.chars[tree.size + leaf] + grow  # end of leaf ``last`` in the new text
        pieces, at = [], begin
        for piece in self.counter.pattern.finditer(self.text, begin):
            while last + 1 < tree.size and end < at:
                last += 1
                end += tree.chars[tree.size + last]
            if at >= settled and at == end and at > begin:
                break
            pieces.append(piece.group())
            at = piece.end()
        else:
            last = tree.size - 1
        tree.put(leaf, at - begin, sum(self.counter.count(pieces)))
        for gone in range(leaf + 1, last + 1):
            if tree.chars[tree.size + gone]:
                tree.put(gone, 0, 0)
        return at - begin


def _counts_task(path: str, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.of(path, pattern)
        for batch in slices(batches):
            before, after, anew, many = [], [], [], []
            for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist()):
                doc = CountedText(text or "", counter)
                before.append(doc.n_tokens)
                anew.append(sum(doc.edit(e["start"] or 0, e["stop"] or 0, e["text"] or "") for e in edits or () if e))
                after.append(doc.n_tokens)
                many.append(len(edits or ()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (before, many, after, anew))],
                                             ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_encoded_anew"])

    return run


def token_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: ``doc_id, n_tokens, n_edits, n_tokens_after, n_chars_encoded_anew``.

    ``docs`` carries ``doc_id, text, edits``; each edit (start, stop, text: a range of characters
    and what replaces it) refers to the text as the edits before it left it; ranges are clipped
    to the text. A null text is empty, null edits are none, null parts of an edit read as 0 or
    empty. Rows that repeat a ``doc_id`` count each. An empty table gives no rows.
    """
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("edits").cast(EDITS).alias("edits")]
    return docs.select(*cols).mapInArrow(_counts_task(path, pattern),
                                         "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_chars_encoded_anew long")


# Personal data the query's edits replace: addresses of mail and of hosts, and long digit groups.
REDACTED = regex.compile(r"(?P<mail>[\w.+-]+@[\w-]+\.[\w.-]+)|(?P<host>\b\d{1,3}(?:\.\d{1,3}){3}\b)|(?P<number>\+?\d[\d ()-]{7,}\d)")


def _redactions_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("text", pa.string())]))
    for batch in slices(batches):
        edits = []
        for text in batch.column("text").to_pylist():
            mine, moved = [], 0
            for m in REDACTED.finditer(text or ""):
                new = f"[{m.lastgroup}]"
                mine.append({"start": m.start() + moved, "stop": m.end() + moved, "text": new})
                moved += len(new) - (m.end() - m.start())
            edits.append(mine)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(edits, kind)], ["doc_id", "text", "edits"])


def with_redactions(docs: DataFrame) -> DataFrame:
    """``doc_id, text, edits``: each text with the edits that replace personal data in it."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _redactions_task, f"doc_id long, text string, edits {EDITS}")
