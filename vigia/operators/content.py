"""Content routing, document text, enrichment, summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse_ws, empty_to_null, lead_words, strip_ws

Summariser = Callable[[Column, Column], Column]


def lead_summariser(words: int) -> Summariser:
    """A summariser that answers with the first ``words`` words of the text (native, no model
    call), a stand-in for a model. A ``pandas_udf`` taking (text, title) can be passed instead."""
    return lambda text, title: lead_words(text, words)


#: U2 default: 30 words.
default_summariser = lead_summariser(30)


def content_route(alerts: DataFrame) -> DataFrame:
    """Which link the content comes from (needs `content_type` from the rules join)."""
    pdf = F.col("pdf") if "pdf" in alerts.columns else F.lit(None).cast("string")
    key = (F.when(F.col("content_type") == "html", F.col("url"))
           .when(F.col("content_type") == "pdf",
                 F.when((F.col("pais") == "Perú") & (F.coalesce(pdf, F.lit("")) != ""), pdf).otherwise(F.col("url"))))
    return alerts.withColumn("content_key", key)


def doc_first_pages(pages: DataFrame, doc: str, page_no: str, text: str, max_pages: int | None = None) -> DataFrame:
    """S9 + W3 + F12: text of the first ``max_pages`` pages (0-based ``page_no``; by default of all
    pages; the reference reads 3), non-empty pages joined by one space in page order, whitespace collapsed, '' → null. The page filter reaches
    the Parquet scan; the ordered concat is one grouped aggregate per document."""
    kept = pages.where(F.col(text) != "").select(doc, page_no, text)
    if max_pages is not None:
        kept = kept.where(F.col(page_no) < max_pages)
    agg = kept.groupBy(doc).agg(F.expr(f"listagg(`{text}`, ' ') within group (order by `{page_no}`)").alias("_t"))
    return agg.select(doc, empty_to_null(collapse_ws(F.col("_t"))).alias("content"))


def summary_fallback(summary: Column, titulo: Column) -> Column:
    """A null/blank summary falls back to the title."""
    return F.coalesce(F.nullif(strip_ws(summary), F.lit("")), titulo)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key (the least row): for tables a left join attaches, so that a page fetched
    twice does not repeat an alert. Applied when such a table is built, not under its join."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, "_r.*")


def newest_fetch(fetches: DataFrame, by: list[str], at: str = "fetched_at") -> DataFrame:
    """One row per ``by``: the newest fetch (no time: older than any; ties, or no column ``at``: the
    least row). Cut ``fetches`` down to the wanted keys first."""
    rest = [c for c in fetches.columns if c not in by]
    order = []
    if at in rest:
        time = F.unix_micros(at) if fetches.schema[at].dataType.typeName() == "timestamp" else F.col(at).cast("long")
        order = [F.coalesce(-time, F.lit((1 << 63) - 1)).alias("_age")]
    out = fetches.groupBy(*by).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return out.select(*by, *[F.col("_r")[c].alias(c) for c in rest])


def enrich(news: DataFrame, content: DataFrame, summariser: Summariser = default_summariser,
           key: str = "content_key") -> DataFrame:
    """J4 + P9: left join to the content table on the chosen link; summary or title. A content table
    with a column ``summary`` brings its own; the summariser is then not asked.

    A Python summariser (``pandas_udf``) runs in an Arrow-batched stage over every joined row:
    Spark lifts Python UDFs out of the ``CASE WHEN``, so rows without content reach it with a
    null text and it should answer null for them (the title is then used)."""
    own = "summary" in content.columns
    c = content.select(F.col(key), F.col("content").alias("_content"), *([F.col("summary").alias("_summary")] if own else []))
    out = news.join(c, on=key, how="left")
    summ = F.col("_summary") if own else F.when(F.col("_content").isNotNull(), summariser(F.col("_content"), F.col("titulo")))
    return out.withColumn("resumen", summary_fallback(summ, F.col("titulo"))).drop("_summary").withColumnRenamed("_content", "content")
