"""Line dedup: repeated runs of lines, found by prefix doubling over line-ID sequences.

Every document is the sequence of its non-blank lines. As in suffix-array construction by prefix
doubling, the name of a position for length w is the first position whose next w lines are the
same: names for length 1 come from grouping equal lines, names for 2 w from grouping equal pairs
(name at i, name at i + w). Positions of one name are an interval of the suffix array with a
common prefix of at least w lines; a position whose next w lines occur once leaves, so a round
handles only what still repeats, and doubling goes on until nothing does. Every round gives the
intervals of its depth: a position whose name is an earlier one begins a later copy of w lines,
and the copies of all depths, laid over each other, are the maximal repeated runs, which go.

The ranks between intervals are not needed (only which positions share a prefix, not which of
them sorts first), so names are positions, not places in a sorted order; and they are not
hashes; two hashes mod 2^61 - 1 under independent bases stand for a line when equal lines are grouped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import PolyHash, mix, raw_bytes, slices, written

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _lines(body: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each line of the text in ``body[a:b]``."""
    breaks = np.flatnonzero(body[a:b] == 10) + a
    return np.concatenate([[a], breaks + 1]), np.concatenate([breaks, [b]])


def _filled(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    solid = np.concatenate([[0], np.cumsum(~_BLANK[body])])
    return solid[end] > solid[start]


def _long(body: np.ndarray, start: np.ndarray, end: np.ndarray, line_words: int | None) -> np.ndarray:
    """Which of the given lines, none empty, have at least ``line_words`` words."""
    if line_words is None or not len(start):
        return np.zeros(len(start), bool)
    begins = ~_BLANK[body]
    begins[1:] &= _BLANK[body[:-1]]
    begins[start] = ~_BLANK[body[start]]
    upto = np.concatenate([[0], np.cumsum(begins)])
    return upto[end] - upto[start] >= line_words


def _lines_task(line_words: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            body, offs = raw_bytes(batch.column("text"))
            if not batch.num_rows:
                continue
            spans = [_lines(body, a, b) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            text = np.repeat(np.arange(len(spans)), [len(s) for s, _ in spans])
            start, end = (np.concatenate(x) for x in zip(*spans))
            keep = _filled(body, start, end)
            text, start, end = text[keep], start[keep], end[keep]
            first = np.searchsorted(text, np.arange(len(spans)))
            one, two = PolyHash(body), PolyHash(body, PolyHash.BASE2)
            size = (end - start).astype(np.uint64)
            pick = pa.array(text)
            yield pa.RecordBatch.from_arrays([
                batch.column("k").take(pick), batch.column("h").take(pick), pa.array((np.arange(len(text)) - first[text]).astype(np.int32)),
                pa.array(mix(one.of(start, end)).view(np.int64)), pa.array(mix(two.of(start, end) ^ size).view(np.int64)),
                pa.array(_long(body, start, end, line_words))], ["k", "h", "i", "l1", "l2", "long"])

    return run


def _named(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """Positions of ``rows`` that share ``key`` with another position: ``p, name``, where the name
    is the least of them."""
    groups = rows.groupBy(*key).agg(F.min("p").alias("least"), F.max("p").alias("top")).filter("least < top").drop("top")
    groups = written(groups, f"{name}-groups")  # nothing is aggregated below the join: a very common key is split
    return written(rows.join(groups, key).select("p", F.col("least").alias("name")), name)


def _doubled(names: DataFrame, step: int) -> DataFrame:
    """Names for w + ``step`` lines from names for w (``step`` at most w)."""
    ahead = names.select(F.struct(F.col("p.k"), F.col("p.h"), (F.col("p.i") - step).alias("i")).alias("p"), F.col("name").alias("next"))
    return _named(names.join(ahead, "p"), ["name", "next"], "line-names")


def repeated_runs(texts: DataFrame, min_lines: int, line_words: int | None = None, whole_documents: bool = False) -> DataFrame:
    """``k, h, i, w``: the w lines from the i-th non-blank one of text (k, h) are a later copy, for every
    depth w of ``min_lines`` times a power of two, as deep as anything repeats."""
    lines = texts.select("k", "h", "text").mapInArrow(_lines_task(line_words), "k long, h long, i int, l1 long, l2 long, long boolean").distinct()
    lines = written(lines.select(F.struct("k", "h", "i").alias("p"), "l1", "l2", *["long"] * (line_words is not None)), "line-ids")
    names, w = _named(lines, ["l1", "l2"], "line-names"), 1
    found = []
    if line_words is not None:
        found.append(names.filter("name < p").join(lines.filter("long").select("p"), "p", "left_semi").select("p.*", F.lit(1).alias("w")))
    if whole_documents:  # a text of min_lines lines or more is a run; of a shorter one all lines count as one
        few = lines.groupBy("p.k", "p.h").agg(F.max("p.i").alias("last")).filter(F.col("last") < min_lines - 1)
        short = lines.select("p.*", "l1", "l2").join(few, ["k", "h"]).groupBy("k", "h", "last").agg(
            F.sort_array(F.collect_list(F.struct("i", "l1", "l2"))).alias("lines"))
        short = written(short.select(F.struct("k", "h", F.col("last").alias("i")).alias("p"), "lines"), "line-documents")
        copies = _named(short, ["lines"], "line-document-names").filter("name < p")
        found.append(copies.select("p.k", "p.h", F.lit(0).alias("i"), (F.col("p.i") + 1).alias("w")))
    while w < min_lines:
        step = min(w, min_lines - w)
        names, w = _doubled(names, step), w + step
    while not names.isEmpty():
        found.append(names.filter("name < p").select("p.*", F.lit(w).alias("w")))
        names, w = _doubled(names, w), 2 * w
    if not found:
        found.append(names.select("p.*", F.lit(w).alias("w")))
    runs = found[0]
    for more in found[1:]:
        runs = runs.union(more)
    return runs


def _clean_task(min_lines: int, line_words: int | None, whole_documents: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            body, offs = raw_bytes(batch.column("text"))
            raw, gone, again = body.tobytes(), batch.column("gone").to_pylist(), batch.column("again").to_pylist()
            lines, removed, runs, texts = [], [], [], []
            for i in range(batch.num_rows):
                start, end = _lines(body, int(offs[i]), int(offs[i + 1]))
                filled = np.flatnonzero(_filled(body[offs[i]:offs[i + 1]], start - offs[i], end - offs[i]))
                out = np.zeros(len(filled), bool)
                if again[i]:  # a row equal in id and text to one before it: all its runs are later copies
                    out[:] = whole_documents or len(filled) >= min_lines or _long(body, start[filled], end[filled], line_words)
                elif gone[i]:
                    for run in gone[i]:
                        out[run["i"]:run["i"] + run["w"]] = True
                keep = np.ones(len(start), bool)
                keep[filled[out]] = False
                lines.append(len(filled))
                removed.append(int(out.sum()))
                runs.append(int((out & ~np.concatenate([[False], out[:-1]])).sum()) if len(out) else 0)
                texts.append(b"\n".join(raw[a:b] for a, b in zip(start[keep].tolist(), end[keep].tolist())).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                pa.array(texts, pa.string()), pa.array([hashlib.md5(t.encode()).hexdigest() for t in texts], pa.string())],
                ["doc_id", "n_lines", "n_removed", "n_runs", "kept", "kept_md5"])

    return run


def line_dedup(docs: DataFrame, *, min_lines: int = 2, line_words: int | None = None, whole_documents: bool = False) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_removed, n_runs, kept, kept_md5`` (``kept`` is the text left).

    Lines end at line feeds; blank lines count for nothing and always stay. A non-blank line goes
    if it lies in ``min_lines`` consecutive non-blank lines that also occur, the same, at an
    earlier position (by doc_id, null first, then text hash, then line), within the document or
    before it; earlier and later copy may overlap. With ``line_words`` a single line of at least so
    many words goes too where the same line occurs earlier, and with ``whole_documents`` all lines
    of a document whose non-blank lines are, all together, those of an earlier one, however few
    and short; without them (as in the registered query, whose SQL fixes the rule) such a line
    stays between lines that do not repeat, and a copy of fewer than ``min_lines`` lines stays
    whole. Null and empty texts keep their (no) lines; of
    rows equal in ``doc_id`` and text the first is the earlier copy. An empty table gives no
    rows. Only ``doc_id`` and ``text`` are read.
    """
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-(1 << 63))).alias("k"), F.xxhash64(text, doc_id.isNull()).alias("h"), text.alias("text"))
    runs = repeated_runs(texts, min_lines, line_words, whole_documents).groupBy("k", "h", "i").agg(F.max("w").alias("w"))
    gone = runs.groupBy("k", "h").agg(F.collect_list(F.struct("i", "w")).alias("gone"))
    again = F.row_number().over(Window.partitionBy("k", "h").orderBy("k")) > 1
    return texts.join(gone, ["k", "h"], "left").withColumn("again", again).select("doc_id", "text", "gone", "again").mapInArrow(
        _clean_task(min_lines, line_words, whole_documents), "doc_id long, n_lines long, n_removed long, n_runs long, kept string, kept_md5 string")


#: The query in DuckDB SQL (min_lines = 2; ids are unique and not null in the given tables).
ORACLE_SQL = r"""
WITH all_lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
filled AS (
    SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
    FROM all_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs AS (
    SELECT a.doc_id, a.i, a.line AS one, b.line AS two
    FROM filled a JOIN filled b ON b.doc_id = a.doc_id AND b.i = a.i + 1),
later AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY one, two ORDER BY doc_id, i) AS n FROM pairs) x
    WHERE n > 1),
gone AS (SELECT doc_id, i FROM later UNION SELECT doc_id, i + 1 FROM later),
marked AS (
    SELECT l.doc_id, l.pos, l.line, f.i, g.i IS NOT NULL AS gone
    FROM all_lines l LEFT JOIN filled f ON f.doc_id = l.doc_id AND f.pos = l.pos
                     LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.i = f.i)
SELECT d.doc_id, CAST(count(m.i) AS BIGINT) AS n_lines, CAST(count(*) FILTER (m.gone) AS BIGINT) AS n_removed,
       CAST(count(*) FILTER (m.gone AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = m.doc_id AND g.i = m.i - 1)) AS BIGINT) AS n_runs,
       md5(coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (NOT m.gone), '')) AS kept_md5
FROM documents d JOIN marked m ON m.doc_id = d.doc_id
GROUP BY d.doc_id
"""
