"""Helpers the operators of this subpackage share: tables, shared scratch, byte and word hashing.

Only ``text`` columns are decoded here; callers select the columns they need first, so extra
columns of the input (whatever their names) never reach an operator.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigia.session import checkpoint_dir

SLICE_BYTES = 1 << 19  # bytes of text worked on at once inside a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/vigia-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to shared storage and read back: lineage ends here, executors may be lost."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null text reads as empty)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` (one row may exceed it)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array as one uint8 array, and n + 1 offsets (null: empty)."""
    if strings.null_count:
        strings = pc.fill_null(strings, "" if pa.types.is_string(strings.type) or pa.types.is_large_string(strings.type) else b"")
    wide = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    _, off, data = strings.buffers()
    offs = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[strings.offset:strings.offset + len(strings) + 1] if off else np.zeros(1, np.int64)
    offs = offs.astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return body, offs - offs[0]


class RollHash:
    """Prefix polynomial hashes mod 2^64 of a byte array: any substring's hash in O(1), fast.

    ``prefix[i]`` is the sum of ``(byte + 1) * base**j`` for j < i; dividing a difference by
    ``base**start`` (the base is odd, so it has an inverse) gives a hash that does not depend on
    the place. Some unequal strings collide under every odd base, so this only chooses places;
    nothing is taken for equal by it.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, body: np.ndarray, base: int = 0x9E3779B97F4A7C15):
        self.powers, self.inverse = self._table(base, len(body) + 1)
        self.prefix = np.zeros(len(body) + 1, np.uint64)
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * self.powers[:len(body)], out=self.prefix[1:])

    @classmethod
    def _table(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(1 << 16, n + n // 4)
            made = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                made.append(np.cumprod(p))
            have = cls._powers[base] = (made[0], made[1])
            if size > SLICE_BYTES * 8:  # a very long text: do not keep its tables
                del cls._powers[base]
        return have

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


PRIME = (1 << 61) - 1
_P, _LOW29, _LOW32 = np.uint64(PRIME), np.uint64((1 << 29) - 1), np.uint64((1 << 32) - 1)
_29, _32, _61, _3 = (np.uint64(k) for k in (29, 32, 61, 3))


def _folded(x: np.ndarray) -> np.ndarray:
    """``x`` mod 2^61 - 1."""
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` mod 2^61 - 1, for values below it."""
    a1, a0, b1, b0 = a >> _32, a & _LOW32, b >> _32, b & _LOW32
    low, middle = a0 * b0, a1 * b0 + a0 * b1
    return _folded(((a1 * b1) << _3) + (middle >> _29) + ((middle & _LOW29) << _32) + (low & _P) + (low >> _61))


class PolyHash:
    """Prefix polynomial hashes mod the prime 2^61 - 1 of a byte array: any substring's hash in O(1).

    As :class:`RollHash`, but unequal strings of n bytes collide for at most n of the 2^61 bases.
    Two hashes under independent bases stand for the bytes where a result hangs on equality of
    strings from anywhere in the corpus.
    """

    BASE, BASE2 = 0x1A4F3B7D59C82E61, 0x0B7E151628AED2A7
    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, body: np.ndarray, base: int = BASE):
        n = len(body)
        powers, self.inverse = self._table(base, n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        for at in range(0, n, 1 << 21):  # sums of 2^21 terms fit 64 bits
            part = body[at:at + (1 << 21)].astype(np.uint64) + np.uint64(1)
            power = powers[at:at + len(part)]
            high, low = np.cumsum(part * (power >> _32)), np.cumsum(part * (power & _LOW32))
            self.prefix[at + 1:at + 1 + len(part)] = _folded((high >> _29) + ((high & _LOW29) << _32) + (low & _P) + (low >> _61) + self.prefix[at])

    @classmethod
    def _table(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            size, made = max(1 << 16, n + n // 4), []
            for b in (base, pow(base, -1, PRIME)):
                p = np.ones(1, np.uint64)
                while len(p) < size:  # the powers so far, times the next one
                    p = np.concatenate([p, _times(p, np.full(len(p), pow(b, len(p), PRIME), np.uint64))])
                made.append(p[:size])
            have = cls._powers[base] = (made[0], made[1])
            if size > SLICE_BYTES * 8:  # a very long text: do not keep its tables
                del cls._powers[base]
        return have

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        a, b = self.prefix[end], self.prefix[start]
        return _times(np.where(a >= b, a - b, a + _P - b), self.inverse[start])


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NOT_ALNUM = np.ones(256, bool)  # ASCII characters that are neither letters nor digits
_NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def words(strings: pa.Array, alnum: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts: runs of bytes other than ASCII white space (``alnum``: runs of
    ASCII letters and digits and of all other characters beyond ASCII).

    Returns (hash per word, first word of each text (n + 1 values), start byte and end byte of
    each word within the joined bytes). Lower-case the array first where case must not count.
    """
    body, offs = raw_bytes(strings)
    n = len(body)
    inside = ~(_NOT_ALNUM if alnum else _SPACE)[body]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return mix(PolyHash(body).of(start, end)), np.searchsorted(start, offs), start, end
