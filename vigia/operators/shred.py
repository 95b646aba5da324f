"""Pages → one long table of element and text rows with their ancestor path.

The only Python stage of the HTML work: a ``mapInArrow`` over (id, html) running the standard
library's HTML event parser. Everything after it (selectors, removal, scope, card fields, text
modes) is DataFrame work over the rows emitted here.

Tree rules (those of the tree builder the reference uses on top of that parser):
  * void elements close at once; an end tag pops to the nearest open element of that name;
    an end tag with no open match is ignored; nothing is closed implicitly;
  * comments, doctype and processing instructions carry no text;
  * text that reaches the parser in pieces (a stray '<', an entity) is one run up to the next
    tag or comment;
  * a text run made only of ASCII whitespace becomes '\\n' (if it holds one) or ' ', except
    inside pre/textarea;
  * text whose innermost special container is script/style/template is tagged with that
    element's id (``cdata_id``), so element text can leave it out unless the element is it.

A page the parser gives up on yields its 'doc' row alone, with the reason in ``text``
(:func:`parse_errors`), never a part of the page.

Row schema (one row per element, text run, and one 'doc' row per page):
  id, seq, kind ('doc'|'el'|'text'), node_id, tag, attrs, text, cdata_id,
  path array<struct<id, tag, cls, classes>> — ancestors from the root, the element itself last
  for 'el' rows; the enclosing elements for 'text' rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PATH_ENTRY = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("cls", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
])


def rows_schema(id_col: str, id_type: T.DataType, keep: list[tuple[str, T.DataType]]) -> T.StructType:
    fields = [T.StructField(id_col, id_type)]
    fields += [T.StructField(k, t) for k, t in keep]
    fields += [
        T.StructField("seq", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("node_id", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("cdata_id", T.IntegerType()),
        T.StructField("path", T.ArrayType(PATH_ENTRY)),
    ]
    return T.StructType(fields)


def _make_shredder(id_col: str, html_col: str, keep_names: list[str], out_schema_json: str, max_rows: int = 20_000):
    """Build the per-partition function."""
    def shred_batches(batches):
        import json

        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        from vigia.operators.tree import TreeParser

        schema = to_arrow_schema(StructType.fromJson(json.loads(out_schema_json)))
        path_type = schema.field("path").type
        entry_type = path_type.value_type

        class Out:
            """Column buffers of one Arrow batch. Path entries are stored once per element
            (``el_*``); a row's path is a run of indexes into them, so the nested column is
            built by one vectorised ``take`` instead of converting Python dicts row by row."""

            def __init__(self):
                self.page, self.seq, self.kind, self.node_id, self.tag = [], [], [], [], []
                self.attrs, self.text, self.cdata_id = [], [], []
                self.path_idx, self.path_off = [], [0]
                self.el_id, self.el_tag, self.el_cls, self.el_classes = [], [], [], []

            def row(self, page, seq, kind, node_id, tag, attrs, text, cdata_id, path):
                self.page.append(page)
                self.seq.append(seq)
                self.kind.append(kind)
                self.node_id.append(node_id)
                self.tag.append(tag)
                self.attrs.append(attrs)
                self.text.append(text)
                self.cdata_id.append(cdata_id)
                self.path_idx.extend(path)
                self.path_off.append(len(self.path_idx))

            def element(self, nid, tag, classes):
                self.el_id.append(nid)
                self.el_tag.append(tag)
                self.el_cls.append(" ".join(classes))
                self.el_classes.append(classes)
                return len(self.el_id) - 1

            def mark(self):
                return (len(self.page), len(self.path_idx), len(self.el_id))

            def back_to(self, mark):
                rows, paths, elements = mark
                for c in (self.page, self.seq, self.kind, self.node_id, self.tag, self.attrs, self.text, self.cdata_id):
                    del c[rows:]
                del self.path_idx[paths:], self.path_off[rows + 1:]
                for c in (self.el_id, self.el_tag, self.el_cls, self.el_classes):
                    del c[elements:]

            def path_column(self):
                elements = pa.StructArray.from_arrays(
                    [pa.array(self.el_id, pa.int32()), pa.array(self.el_tag, pa.string()),
                     pa.array(self.el_cls, pa.string()), pa.array(self.el_classes, pa.list_(pa.string()))],
                    fields=list(entry_type))
                values = elements.take(pa.array(self.path_idx, pa.int64()))
                return pa.ListArray.from_arrays(pa.array(self.path_off, pa.int32()), values, type=path_type)

        class Shredder(TreeParser):
            def __init__(self, out, page):
                super().__init__()
                self.out = out
                self.page = page
                self.gstack = []         # entry indexes of the open elements in ``out``

            def element(self, nid, tag, attrs, stays_open):
                g = self.out.element(nid, tag, attrs.get("class", "").split())
                self.out.row(self.page, self.seq, "el", nid, tag, list(attrs.items()), None, None, self.gstack + [g])
                if stays_open:
                    self.gstack.append(g)

            def cut(self, depth):
                del self.gstack[depth:]

            def text(self, parent, data, cdata_id):
                self.out.row(self.page, self.seq, "text", parent, None, None, data, cdata_id, self.gstack)

        def finish(batch, out):
            take = pa.array(out.page, pa.int64())
            cols = {id_col: batch.column(id_col).take(take)}
            for k in keep_names:
                cols[k] = batch.column(k).take(take)
            cols["seq"] = pa.array(out.seq, pa.int32())
            cols["kind"] = pa.array(out.kind, pa.string())
            cols["node_id"] = pa.array(out.node_id, pa.int32())
            cols["tag"] = pa.array(out.tag, pa.string())
            cols["attrs"] = pa.array(out.attrs, schema.field("attrs").type)
            cols["text"] = pa.array(out.text, pa.string())
            cols["cdata_id"] = pa.array(out.cdata_id, pa.int32())
            cols["path"] = out.path_column()
            return pa.RecordBatch.from_arrays([cols[f.name].cast(f.type) for f in schema], schema=schema)

        for batch in batches:
            out = Out()
            for i in range(batch.num_rows):
                html = batch.column(html_col)[i].as_py()
                mark = out.mark()
                out.row(i, 0, "doc", None, None, None, None, None, ())
                if html:
                    p = Shredder(out, i)
                    try:
                        p.read(html)
                    except Exception as e:  # malformed beyond the parser: nothing of the page, a reason
                        out.back_to(mark)
                        out.row(i, 0, "doc", None, None, None, f"{type(e).__name__}: {e}", None, ())
                # rows and paths held at once are bounded, whatever the batch holds (one page may exceed it)
                if len(out.page) >= max_rows or len(out.path_idx) >= 8 * max_rows:
                    yield finish(batch, out)
                    out = Out()
            if out.page:
                yield finish(batch, out)

    return shred_batches


def shred(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: list[str] | None = None,
          partitions: int | None = None) -> DataFrame:
    """Shred every page into element/text rows. ``keep`` columns ride along unchanged.

    Catalyst does not push filters or pruning through ``mapInArrow``, so the input is projected
    here to the columns the parser needs. By default the input keeps its own splits (a Parquet
    scan is cut into byte-bounded splits, and raw markup is not shuffled). Pages assembled
    upstream may sit in a handful of coalesced partitions: ``partitions`` then deals them out by
    a hash of the id (not the id itself: an input already partitioned by id would let the planner
    drop the exchange), a fixed count that AQE does not coalesce.
    """
    keep = keep or []
    src = dealt(pages.select(id_col, html_col, *keep), id_col, partitions)
    id_type = src.schema[id_col].dataType
    keep_types = [(k, src.schema[k].dataType) for k in keep]
    schema = rows_schema(id_col, id_type, keep_types)
    fn = _make_shredder(id_col, html_col, keep, schema.json())
    return src.mapInArrow(fn, schema)


def dealt(pages: DataFrame, id_col: str, partitions: int | None) -> DataFrame:
    """``pages`` over ``partitions`` parse tasks by a hash of the id; as they are, without it."""
    return pages.repartition(partitions, F.xxhash64(id_col)) if partitions else pages


def spread(pages: DataFrame) -> int | None:
    """``partitions`` for :func:`shred` of a scan: a file of fewer splits than cores is dealt out
    over the cores, anything larger keeps its splits (no exchange)."""
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return cores if pages.rdd.getNumPartitions() < cores else None


def parse_errors(rows: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Pages the parser gave up on, with the reason: rows for the quarantine table."""
    return rows.where((F.col("kind") == "doc") & F.col("text").isNotNull()).select(id_col, F.col("text").alias("error"))
