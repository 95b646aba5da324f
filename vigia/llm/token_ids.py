"""Token-ID output in patched frame-of-reference blocks.

Documents are range-partitioned by ``doc_id``; each task encodes its texts in order and writes
segments. A segment is one binary value, written by Spark next to a few plain columns (the file
must land in whatever store the cluster shares, so Spark's own writer carries it):

    header     <4s I I I I I> magic ``PFR1``, documents, ids, ids per block, blocks, exceptions
    documents  length of each document (uint32)
    index      start byte of each block in the packed area (uint32, blocks + 1 values)
    minima     block minimum (uint32), widths (uint8), exceptions per block (uint8)
    outliers   place within the block (uint8), then the bits above the width (uint32)
    packed     per block: ids less the minimum, the low ``width`` bits of each, little-endian

A block's width is the bit length that a given percentile of its values fits; the others keep
their high bits in the exception list. A document never spans two segments.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import documents, raw_bytes, scratch, slices

MAGIC = b"PFR1"
BLOCK = 128
HEADER = struct.Struct("<4sIIIII")
SEGMENT_SCHEMA = "part int, seq int, part_start long, n_ids long, doc_ids array<long>, segment binary"


# ---- tokenizer -----------------------------------------------------------------------------

# Byte classes: 0 blank, 1 letter, 2 digit, 3 other ASCII, 4 apostrophe, 5 beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 13, 32]] = 0
_CLASS[97:123] = 1
_CLASS[48:58] = 2
_CLASS[39] = 4
_CLASS[128:] = 5
# Where a piece may be cut between two bytes of these classes. The tokenizer's splitter never
# keeps these together (a letter run ends at any other character, digits stand alone), and no
# normalisation joins two ASCII characters. Nothing is cut beside a byte beyond ASCII, nor
# between an apostrophe and a letter (contractions).
_CUT = np.zeros((6, 6), bool)
for _left, _right in ((1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 3), (2, 4), (3, 1), (3, 2), (4, 2)):
    _CUT[_left, _right] = True
_CUT[0, :] = True
_CUT[:, 0] = True
_CUT_FLAT = _CUT.ravel()


# Texts that a tokenizer with other rules cuts or spells otherwise.
PROBES = ["The quick BROWN fox's 12345 jumps-over (it)!! don't we'll  two\nlines\tand\r\nmore...", " lead, trail ", "a1b2 3.14 x_y $5 #tag @me e-mail", "Ñandú ÀÉ naïve “q” — 中文 ñ's é1", ""]


class PieceEncoder:
    """Encodes whole texts through the tokenizers library, one distinct piece at a time.

    A text is cut where its tokenizer (lower case, blanks dropped, runs of letters, single
    digits, runs of other characters) cuts it in any case, so its ids are its pieces' ids in
    order. Each distinct piece is encoded once and kept: up to ``keep`` pieces of at most 64
    bytes, looked up by their bytes. A text that holds one of the tokenizer's own special
    strings is encoded whole.
    """

    _made: dict[str, PieceEncoder] = {}

    def __init__(self, path: str, keep: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keep = keep
        self.known: dict[bytes, bytes] = {}
        if self.encode(pa.array(PROBES)) != self._ids(PROBES):
            raise ValueError(f"{path} does not cut its texts as this encoder does")

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        """One encoder a worker process: what a task has learnt serves the next."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, strings: pa.Array) -> list[bytes]:
        """Little-endian uint32 ids of each text (null: none)."""
        strings = pc.fill_null(strings, "")
        body, offs = raw_bytes(strings)
        body = _LOWER[body]
        kind = _CLASS[body]
        cut = np.ones(len(body) + 1, bool)
        if len(body):
            cut[1:-1] = _CUT_FLAT[kind[:-1] * np.uint8(6) + kind[1:]]
        cut[offs] = True
        edge = np.flatnonzero(cut)
        start, end = edge[:-1], edge[1:]
        solid = kind[start] > 0 if len(start) else np.zeros(0, bool)
        start, end = start[solid], end[solid]
        # a blank is always cut off, so all other bytes, joined, are the pieces
        at = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        joined = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(body[kind > 0].tobytes())])
        coded_pieces = joined.dictionary_encode()
        which, pieces = coded_pieces.indices.to_numpy(), coded_pieces.dictionary.to_pylist()
        known = self.known
        coded = list(map(known.get, pieces))
        missed = [i for i, ids in enumerate(coded) if ids is None]
        for at in range(0, len(missed), 4096):
            part = missed[at:at + 4096]
            for i, ids in zip(part, self._ids([pieces[i].decode() for i in part])):
                coded[i] = ids
                if len(pieces[i]) <= 64:
                    known[pieces[i]] = ids
        if len(known) > self.keep:
            known.clear()
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        flat, first = np.frombuffer(b"".join(coded), "<u4"), np.cumsum(size) - size
        many = size[which]
        ends = np.concatenate([[0], np.cumsum(many)])
        ids = flat[np.repeat(first[which] - ends[:-1], many) + np.arange(ends[-1])].tobytes()
        text_end = (4 * ends[np.searchsorted(start, offs)]).tolist()
        out = [ids[a:b] for a, b in zip(text_end, text_end[1:])]
        for token in self.special:
            for i in np.flatnonzero(pc.match_substring(strings, token).to_numpy(zero_copy_only=False)):
                out[i] = self._ids([strings[int(i)].as_py()])[0]
        return out


# ---- segments ------------------------------------------------------------------------------

def _bit_length(v: np.ndarray) -> np.ndarray:
    return np.where(v > 0, np.frexp(v.astype(np.float64))[1], 0).astype(np.int64)


def pack_segment(ids: np.ndarray, lengths: list[int], percentile: float = 90.0) -> bytes:
    """One segment of uint32 ``ids``; ``lengths`` are the documents' id counts, in order."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    full = np.zeros(blocks * BLOCK, np.uint32)
    full[:n] = ids
    if n % BLOCK:
        full[n:] = ids[-1]
    rows = full.reshape(blocks, BLOCK)
    low = rows.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rest = (rows - low[:, None]).astype(np.uint64)
    at = min(BLOCK - 1, int(np.ceil(percentile / 100 * BLOCK)) - 1)
    width = _bit_length(np.partition(rest, at, axis=1)[:, at]) if blocks else np.zeros(0, np.int64)
    block, place = np.nonzero(rest >> width[:, None].astype(np.uint64)) if blocks else (np.zeros(0, int),) * 2
    high = (rest[block, place] >> width[block].astype(np.uint64)).astype("<u4")
    words = 2 * width  # 128 values of w bits fill 2 w words of 64 bits
    starts = np.concatenate([[0], np.cumsum(words)])
    packed = np.zeros(int(starts[-1]), np.uint64)
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        vals = rest[own] & np.uint64((1 << int(w)) - 1)
        out = np.zeros((len(own), 2 * w), np.uint64)
        for i in range(BLOCK):
            k, s = divmod(i * int(w), 64)
            out[:, k] |= vals[:, i] << np.uint64(s)
            if s + w > 64:
                out[:, k + 1] |= vals[:, i] >> np.uint64(64 - s)
        packed[(starts[own][:, None] + np.arange(2 * w)).ravel()] = out.ravel()
    return b"".join([
        HEADER.pack(MAGIC, len(lengths), n, BLOCK, blocks, len(block)),
        np.asarray(lengths, "<u4").tobytes(),
        (starts * 8).astype("<u4").tobytes(),
        low.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(),
        np.bincount(block, minlength=blocks).astype(np.uint8).tobytes(),
        place.astype(np.uint8).tobytes(), high.tobytes(),
        packed.astype("<u8").tobytes(),
    ])


class Segment:
    """Reads a segment; ``ids(first, last)`` decodes only the blocks that hold the range."""

    def __init__(self, data: bytes):
        magic, docs, self.n, block, blocks, outliers = HEADER.unpack_from(data)
        if magic != MAGIC or block != BLOCK:
            raise ValueError("not a PFR1 segment")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, count, at)
            at += got.nbytes
            return got

        self.lengths = take("<u4", docs).astype(np.int64)
        self.index = take("<u4", blocks + 1).astype(np.int64)
        self.low, self.width, counts = take("<u4", blocks), take("u1", blocks), take("u1", blocks)
        self.first_outlier = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.place, self.high = take("u1", outliers), take("<u4", outliers)
        self.packed = np.frombuffer(data, "<u8", -1, at)

    def ids(self, first: int, last: int) -> np.ndarray:
        if last <= first:
            return np.zeros(0, "<u4")
        b0, b1 = first // BLOCK, -(-last // BLOCK)
        out = np.zeros((b1 - b0, BLOCK), np.uint64)
        width, starts = self.width[b0:b1], self.index[b0:b1] // 8
        for w in np.unique(width[width > 0]):
            own = np.flatnonzero(width == w)
            w = int(w)
            src = self.packed[starts[own][:, None] + np.arange(2 * w)]
            mask = np.uint64((1 << w) - 1)
            got = np.zeros((len(own), BLOCK), np.uint64)
            for i in range(BLOCK):
                k, s = divmod(i * w, 64)
                v = src[:, k] >> np.uint64(s)
                if s + w > 64:
                    v = v | (src[:, k + 1] << np.uint64(64 - s))
                got[:, i] = v & mask
            out[own] = got
        lo, hi = self.first_outlier[b0], self.first_outlier[b1]
        if hi > lo:
            block = np.repeat(np.arange(b1 - b0), np.diff(self.first_outlier[b0:b1 + 1]))
            out[block, self.place[lo:hi]] |= self.high[lo:hi].astype(np.uint64) << width[block].astype(np.uint64)
        out += self.low[b0:b1, None].astype(np.uint64)
        return out.reshape(-1)[first - b0 * BLOCK:last - b0 * BLOCK].astype("<u4")


# ---- Spark jobs ----------------------------------------------------------------------------

def _encoder_task(tokenizer_path: str, end_id: int, segment_ids: int, percentile: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = PieceEncoder.of(tokenizer_path)
        part = TaskContext.get().partitionId()
        end = np.asarray([end_id], "<u4").tobytes()
        held: list[bytes] = []
        names: list[int | None] = []
        seq = start = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, start, size
            ids = np.frombuffer(b"".join(held), "<u4")
            seg = pack_segment(ids, [len(x) // 4 for x in held], percentile)
            out = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([seg], pa.binary()),
            ], ["part", "seq", "part_start", "n_ids", "doc_ids", "segment"])
            seq, start, size = seq + 1, start + len(ids), 0
            held.clear()
            names.clear()
            return out

        for batch in slices(batches, limit=6 << 20):
            coded = enc.encode(batch.column("text"))
            for name, ids in zip(batch.column("doc_id").to_pylist(), coded):
                held.append(ids + end)
                names.append(name)
                size += len(held[-1]) // 4
                if size >= segment_ids:
                    yield flush()
        if held:
            yield flush()

    return run


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, *,
                    segment_ids: int = 1 << 18, percentile: float = 90.0) -> str:
    """Encode every whole text and write segments in ascending ``doc_id`` order under ``path``.

    Nulls in ``text`` encode as an empty document (its end id only); a null ``doc_id`` sorts
    first; rows that repeat a ``doc_id`` stay, each its own document, ordered by text hash. An
    empty table writes no segment. Only ``doc_id`` and ``text`` are read.

    Ties in ``doc_id`` may hold any share of the rows: text hash and row number are part of the
    range key, so they split too. A task holds one segment (``segment_ids`` ids, or one document).
    """
    keyed = documents(docs).select("doc_id", "text", F.xxhash64("text").alias("h"),
                                   F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("row")]
    (keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(_encoder_task(tokenizer_path, end_id, segment_ids, percentile), SEGMENT_SCHEMA)
     .write.option("compression", "none").parquet(path))
    return path


def _reader_task(bases: dict[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                seg = Segment(r["segment"])
                ends = np.cumsum(seg.lengths)
                body = seg.ids(0, seg.n).tobytes()
                first = ends - seg.lengths
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["doc_ids"], pa.int64()),
                    pa.array(first + (bases[r["part"]] + r["part_start"])),
                    pa.array(seg.lengths),
                    pa.array([zlib.crc32(body[4 * a:4 * b]) for a, b in zip(first, ends)], pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_token_ids(spark, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    The id counts per written part (one number a file, never one a document) go to the driver
    and back to the readers as the parts' base offsets.
    """
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    totals = sorted((r["part"], r["n"]) for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases, done = {}, 0
    for part, n in totals:
        bases[part] = done
        done += n
    return segments.mapInArrow(_reader_task(bases), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the corpus' token ids to the shared folder and return the digest read back from it."""
    spark = docs.sparkSession
    return read_token_ids(spark, write_token_ids(docs, scratch(spark, "token-ids"), tokenizer_path, end_id))
