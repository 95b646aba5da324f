"""Source profiles as rows, compiled to one plan for all sources.

A profile row says where a source's records are (container, fields, cells), which of them make the
title, the date and the link, how a date reads and what a bad one means, what a record must have.
:func:`compile_profiles` turns any number of rows into one job: every page is parsed once under the
masks of its source, records are grouped in one exchange, and title, date, link and filters are
Column expressions over the profile's columns, which ride on the records by one small join. A new
source is a new row; the plan does not grow with the sources.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_ts
from ..functions.text import clean_title_costarica, clean_title_mexico, strip_ws
from ..functions.urls import absolute_url
from .history import dedupe_last
from .masks import PART_FIELDS, element_text, parsed_pages, record_cells, record_program, record_reader, records_of
from .profiles import NO_TITLE, PROFILES
from .select import Field, RecordSpec

#: Title rules by name.
CLEANERS = {"pdf name": clean_title_mexico, "leading date": lambda t: clean_title_costarica(strip_ws(t))}


@dataclass(frozen=True)
class ProfileRow:
    """One source. References (``title``, ``date``, ``link``) are field names, ``cell:2`` (text, or for
    the link the link, of the second cell) or ``attr:href`` (an attribute of the container)."""
    source_id: str
    source_rank: int
    pais: str
    institucion: str
    container: str
    fields: dict[str, dict] = field(default_factory=dict)  # name → selector, value, parent
    cells_tag: str | None = None
    min_cells: int = 0
    required: tuple[str, ...] = ()  # fields a record must have, or it is none
    fatal_without: str | None = None  # a field whose absence fails the row
    fatal_reason: str | None = None
    title: tuple[str, ...] = ()
    title_sep: str = " - "
    title_default: str | None = None
    title_rule: str | None = None  # a name of CLEANERS
    date: tuple[str, ...] = ()
    date_pattern: str | None = None  # the part of the value that is the date
    date_formats: tuple[str, ...] = ()
    date_out: str = "dd-MM-yyyy"
    date_empty: bool = True  # an empty value is a bad one (False: it is missing)
    date_missing: str | None = None
    date_bad: str = "raw"  # raw: kept, the first reference alone; drop; fatal
    link: str = "href"
    link_rule: str = "as is"  # as is, prefix, absolute
    link_base: str = ""
    link_required: bool = True  # a record without one is none; else (absolute) an absent link is the base
    year: str = "any"  # any; only: a date of the run's year; not other: no date of another year
    keep_last: bool = False  # of records with the same link the last values win
    top_n: int | None = None  # records of a category, in page and document order
    scope: str = "source"  # what a failure takes down in parity mode: the source, or one category of it


def _fields(source: str) -> dict[str, dict]:
    return {k: {"selector": f.selector, "value": f.value, "parent": f.parent} for k, f in PROFILES[source].spec.fields.items()}


def _known(source: str, **rest) -> ProfileRow:
    p = PROFILES[source]
    return ProfileRow(p.source_id, p.source_rank, p.pais, p.institucion, p.spec.container, _fields(source), p.spec.cells_tag, link_base=p.base_url or "", **rest)


#: The six listing sources.
ROWS = [
    _known("brasil", required=("href", "fecha_raw"), title=("titulo",), date=("fecha_raw", "hora_raw"), date_formats=("d/M/yyyy H:m",), date_out="dd-MM-yyyy HH:mm",
           fatal_without="hora_raw", fatal_reason="time node missing"),
    _known("colombia", required=("titulo", "fecha_raw", "href"), title=("titulo",), date=("fecha_raw",), date_formats=("yyyy-M-d",), date_bad="fatal"),
    _known("mexico", required=("titulo", "href"), title=("titulo",), title_rule="pdf name", date=("titulo",), date_pattern="[0-9]{8}", date_formats=("ddMMyyyy",),
           date_missing="Sin Fecha", link_rule="prefix"),
    _known("argentina", title=("titulo",), title_default=NO_TITLE, date=("fecha_raw",), date_formats=("yyyy-M-d H:m:s",), date_out="dd-MM-yyyy HH:mm", date_empty=False,
           date_missing="Sin fecha", link="attr:href", link_rule="absolute", link_required=False, scope="category"),
    _known("bolivia", min_cells=4, title=("cell:1", "cell:2"), date=("cell:3",), date_formats=("d/M/yyyy",), date_bad="drop", link="cell:4", link_rule="absolute",
           year="only", keep_last=True, scope="category"),
    _known("costarica", required=("data_title",), title=("data_title",), title_default=NO_TITLE, title_rule="leading date", date=("fecha_raw",), date_formats=("yyyy-M-d H:m:s",),
           date_out="dd-MM-yyyy HH:mm", date_empty=False, date_missing="Sin fecha", link_rule="absolute", year="not other", keep_last=True,
           scope="category"),
]

_COLUMNS = T.StructType([
    T.StructField("source_id", T.StringType()), T.StructField("source_rank", T.IntegerType()), T.StructField("pais", T.StringType()), T.StructField("institucion", T.StringType()),
    T.StructField("min_cells", T.IntegerType()), T.StructField("required", T.ArrayType(T.StringType())), T.StructField("fatal_without", T.StringType()),
    T.StructField("fatal_reason", T.StringType()), T.StructField("title", T.ArrayType(T.StringType())), T.StructField("title_sep", T.StringType()),
    T.StructField("title_default", T.StringType()), T.StructField("title_rule", T.StringType()), T.StructField("date", T.ArrayType(T.StringType())),
    T.StructField("date_pattern", T.StringType()), T.StructField("date_formats", T.ArrayType(T.StringType())), T.StructField("date_out", T.StringType()),
    T.StructField("date_empty", T.BooleanType()), T.StructField("date_missing", T.StringType()), T.StructField("date_bad", T.StringType()), T.StructField("link", T.StringType()),
    T.StructField("link_rule", T.StringType()), T.StructField("link_base", T.StringType()), T.StructField("link_required", T.BooleanType()), T.StructField("year", T.StringType()),
    T.StructField("keep_last", T.BooleanType()), T.StructField("top_n", T.IntegerType()),
])
OUT = ["url", "titulo", "fecha", "fecha_ts", "pais", "institucion", "source_id", "source_rank", "categoria", "categoria_rank", "page_id", "item_pos", "fatal"]


def _check(rows: Sequence[ProfileRow]) -> None:
    for r in rows:
        for ref in (*r.title, *r.date, r.link, *r.required, *([r.fatal_without] if r.fatal_without else [])):
            known = ref in r.fields or (ref.startswith("cell:") and ref[5:].isdigit() and r.cells_tag) or ref.startswith("attr:")
            if not known:
                raise ValueError(f"profile {r.source_id}: {ref!r} is neither a field, a cell nor an attribute")
        if r.title_rule not in (None, *CLEANERS) or r.link_rule not in ("as is", "prefix", "absolute") or r.date_bad not in ("raw", "drop", "fatal") or r.year not in ("any", "only", "not other") or r.scope not in ("source", "category"):
            raise ValueError(f"profile {r.source_id}: unknown rule")
    if len({r.source_id for r in rows}) < len(rows):
        raise ValueError("a source has two profiles")


def _records(pages: DataFrame, rows: Sequence[ProfileRow], carried: list[str]) -> DataFrame:
    """One row a container: ``values`` (field → first value), ``card_attrs``, ``cells``, ``page_error``."""
    specs = {r.source_id: RecordSpec(r.container, {k: Field(**f) for k, f in r.fields.items()}, cells_tag=r.cells_tag) for r in rows}
    programs = {s: record_program(spec) for s, spec in specs.items()}

    def readers():
        made = {s: record_reader(p) for s, p in programs.items()}
        return lambda html, source: made[source](html)

    page = ["page_id", *carried]
    parts = parsed_pages(pages.withColumn("_source", F.col("source_id")), readers, "page_id", carried, PART_FIELDS, extra="_source")
    cards = records_of(parts, page)
    modes = [x for r in rows for k, f in r.fields.items() for x in (F.lit(f"{r.source_id}/{k}"), F.lit(f.get("value", "text_b")))]
    mode_of = F.create_map(*modes) if modes else F.lit(None).cast("map<string,string>")

    def value(name: Column, e: Column) -> Column:
        mode = F.try_element_at(mode_of, F.concat(F.col("source_id"), F.lit("/"), name))
        return (F.when(mode == "text_a", element_text(e, "text_a")).when(mode == "text_b", element_text(e, "text_b")).when(mode == "text_c", element_text(e, "text_c"))
                .otherwise(F.try_element_at(e["attrs"], F.substring(mode, 6, 1000))))

    none = F.array().cast("array<struct<f:string,o:int,v:string>>")

    def marks(e: Column) -> Column:
        own = F.when(e["elem_id"] != F.col("card_id"), F.transform(e["self_f"], lambda n: F.struct(n.alias("f"), e["elem_id"].alias("o"), value(n, e).alias("v"))))
        above = F.transform(e["par_marks"], lambda m: F.struct(m["f"].alias("f"), m["o"].alias("o"), value(m["f"], e).alias("v")))
        return F.concat(F.coalesce(own, none), F.coalesce(above, none))

    tags = F.create_map(*[F.lit(x) for r in rows if r.cells_tag for x in (r.source_id, r.cells_tag)]) if any(r.cells_tag for r in rows) else F.lit(None).cast("map<string,string>")
    cards = cards.select(*page, "card_id", F.try_element_at(F.filter("elems", lambda e: e["elem_id"] == F.col("card_id")), F.lit(1))["attrs"].alias("card_attrs"),
                         F.array_sort(F.flatten(F.transform("elems", marks))).alias("_all"),
                         record_cells(F.try_element_at(tags, F.col("source_id"))).alias("cells"), "page_error")
    names = F.array_distinct(F.transform("_all", lambda m: m["f"]))  # marks are sorted by field, then place: the first of a field is its value
    return cards.withColumn("values", F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter("_all", lambda m: m["f"] == n), 1)["v"]))).drop("_all")


def _ref(ref: Column, link: bool = False) -> Column:
    cell = F.try_element_at(F.col("cells"), F.greatest(F.substring(ref, 6, 9).try_cast("int"), F.lit(1)))
    return (F.when(ref.startswith("cell:"), cell["link"] if link else cell["text_a"])
            .when(ref.startswith("attr:"), F.try_element_at(F.col("card_attrs"), F.substring(ref, 6, 1000)))
            .otherwise(F.try_element_at(F.col("values"), ref)))


def compile_profiles(pages: DataFrame, rows: Sequence[ProfileRow], run_year: int) -> DataFrame:
    """Listing pages (``source_id, page_id, categoria, categoria_rank, html``) of the sources in ``rows``
    → alerts (:data:`OUT`). Pages of other sources take no part. A page that cannot be read, a row
    that fails: one row with ``fatal``."""
    _check(rows)
    spark = pages.sparkSession
    carried = ["source_id", "categoria", "categoria_rank"]
    table = spark.createDataFrame([tuple((list(v) if isinstance(v, tuple) else v) for v in (asdict(r)[f.name] for f in _COLUMNS)) for r in rows], _COLUMNS)
    mine = pages.where(F.col("source_id").isin([r.source_id for r in rows]))
    r = _records(mine, rows, carried).join(F.broadcast(table), "source_id")  # the driver holds these few rows anyway
    unread = F.col("page_error").isNotNull()
    if any(row.top_n is not None for row in rows):
        order = Window.partitionBy("source_id", "categoria", unread).orderBy("page_id", "card_id")
        r = r.withColumn("_rn", F.row_number().over(order)).where(unread | F.col("top_n").isNull() | (F.col("_rn") <= F.col("top_n"))).drop("_rn")
    has = F.forall("required", lambda n: F.map_contains_key("values", n)) & (F.size("cells") >= F.col("min_cells"))
    r = r.withColumn("_link", F.nullif(_ref(F.col("link"), link=True), F.lit("")))
    # a link that only a later step misses (an absolute one) leaves no url, and such a record goes with its key
    r = r.where(unread | (has & (~F.col("link_required") | F.col("_link").isNotNull())))
    parts = F.transform("title", lambda x: _ref(x))
    plain = F.when(F.exists(parts, lambda x: x.isNull()), F.col("title_default")).otherwise(F.array_join(parts, "\0"))
    title = F.replace(plain, F.lit("\0"), F.col("title_sep"))
    clean = title
    for name, rule in CLEANERS.items():
        clean = F.when(F.col("title_rule") == name, rule(title)).otherwise(clean)
    dates = F.transform("date", lambda x: _ref(x))
    joined = F.when(~F.exists(dates, lambda x: x.isNull()), F.array_join(dates, " "))
    found = F.when(F.col("date_pattern").isNull(), joined).otherwise(F.nullif(F.regexp_substr(joined, F.col("date_pattern")), F.lit("")))
    r = r.withColumn("titulo", F.when(~unread, clean)).withColumn("_raw", F.when(F.col("date_empty"), found).otherwise(F.nullif(found, F.lit(""))))
    r = r.withColumn("_keep", F.when(F.size("date") > 1, F.element_at(dates, 1)).otherwise(F.col("_raw")))
    formats = list(dict.fromkeys(f for row in rows for f in row.date_formats))
    ts = F.coalesce(F.lit(None).cast("timestamp"), *[F.when(F.array_contains("date_formats", f), parse_ts("_raw", (f,))) for f in formats])
    r = r.withColumn("fecha_ts", ts)
    shown = F.lit(None).cast("string")
    for out in dict.fromkeys(row.date_out for row in rows):
        shown = F.when(F.col("date_out") == out, F.date_format("fecha_ts", out)).otherwise(shown)
    bad = F.col("_raw").isNotNull() & F.col("fecha_ts").isNull()
    r = r.withColumn("fecha", F.when(unread, F.lit(None)).when(F.col("_raw").isNull(), F.col("date_missing")).when(bad, F.when(F.col("date_bad") == "raw", F.col("_keep"))).otherwise(shown))
    same = F.year("fecha_ts") == run_year
    in_year = F.when(F.col("year") == "only", F.coalesce(same, F.lit(False))).when(F.col("year") == "not other", F.coalesce(same, F.lit(True))).otherwise(F.lit(True))
    r = r.where(unread | (in_year & ~((F.col("date_bad") == "drop") & F.col("fecha_ts").isNull())))
    failed = (F.when((F.col("date_bad") == "fatal") & bad, F.concat(F.lit("bad date: "), F.col("_raw")))
              .when(F.col("fatal_without").isNotNull() & ~F.map_contains_key("values", F.col("fatal_without")), F.col("fatal_reason")))
    absolute = F.when(F.col("_link").isNotNull() | ~F.col("link_required"), absolute_url(F.col("link_base"), F.col("_link")))
    url = F.when(F.col("link_rule") == "prefix", F.concat("link_base", "_link")).when(F.col("link_rule") == "absolute", absolute).otherwise(F.col("_link"))
    r = (r.withColumn("url", F.when(~unread, url)).withColumn("fatal", F.coalesce("page_error", failed))
         .withColumn("item_pos", F.col("card_id").cast("bigint")))
    if any(row.keep_last for row in rows):
        one = F.concat_ws("\0", "source_id", F.col("page_id").cast("string"), F.col("card_id").cast("string"))
        last = F.col("keep_last") & F.col("fatal").isNull()
        keyed = r.withColumn("_key", F.when(last, F.concat_ws("\0", "source_id", "url")).otherwise(one)).select("_key", *OUT)
        r = dedupe_last(keyed, key="_key")
    return r.select(*OUT)
