"""The alert job end to end (collect → novelty → enrich → outbox → merge) and the flagship query.

Stage order follows the reference: novelty is decided before the costly steps, so only new
pages are parsed for their content, extracted and summarised. What several steps read (flagged
alerts, details, fresh links, content, enriched news) is written once to shared storage.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import host_of
from ..operators import content as C
from ..operators import errors as E
from ..operators import history as H
from ..operators import notify as N
from ..operators import profiles as PR
from ..operators.compiled import ROWS, ProfileRow, compile_profiles
from ..operators.masks import page_content
from ..operators.shred import dealt, spread
from ..operators.summary import with_summaries
from ..session import checkpoint_dir
from ..sources.alert_store import AlertStore
from ..sources.content_store import ContentStore, PlainContent
from ..sources import feeds as FD
from ..sources import history as HS
from ..sources import rules as RU
from .standins import PAGE_RULES, T

KEEP = ["categoria", "categoria_rank"]


def with_scope(df: DataFrame, profiles: Sequence[ProfileRow] = ROWS) -> DataFrame:
    """What a failure takes down with it, in parity mode: the source, or one of its categories."""
    by_category = [p.source_id for p in profiles if p.scope == "category"]
    return df.withColumn("scope", F.when(F.col("source_id").isin(by_category), F.concat_ws("/", "source_id", "categoria")).otherwise(F.col("source_id")))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, whatever reads it, and a
    join on it can be split (nothing is aggregated between its exchange and the join)."""
    path = f"{checkpoint_dir(df.sparkSession)}/vigia-job/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def feeds(feed_docs: DataFrame, detail_pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """S1 + D1 + S6 + J2 + P1: fetched feeds of Peru and Chile (source_id, page_id, categoria,
    categoria_rank, xml) as alerts; Peru's items get their detail page (url, page_id, html, and
    fetched_at if it is known). Of a detail page fetched twice the newest counts. Details are
    written, one row a link, before they are joined: a link that many items share is then split."""
    keep = ["page_id", *KEEP]
    at = [c for c in ("fetched_at",) if c in detail_pages.columns]
    newest = C.newest_fetch(detail_pages.select("url", "page_id", "html", *at), ["url"]).select("url", "page_id", "html")
    details = PR.detail_fields(dealt(newest, "page_id", partitions)).select("url", "page_id", "motivo", "producto", "pdf")
    details = stored(details, "details")

    def items(source: str) -> DataFrame:
        return FD.with_feed_date(FD.feed_items(feed_docs.where(F.col("source_id") == source), keep=keep), source)

    peru = PR.feed_with_detail(items("peru"), details)
    return PR.feed_alerts(peru, "peru").unionByName(PR.feed_alerts(items("chile"), "chile"))


def flagged(listing_pages: DataFrame, feed_docs: DataFrame, detail_pages: DataFrame, run_year: int, *,
            profiles: Sequence[ProfileRow] = ROWS, partitions: int | None = None) -> DataFrame:
    """U-1 + E8: fetched pages and feeds (source_id, page_id, categoria, categoria_rank, status, html
    or xml) → alerts of the two feeds and of all sources with a profile row, in one schema, and
    whatever could not be read, in one written table. ``fatal`` is the reason of rows that cannot be used (a failed fetch, an
    unreadable page, a failed row, an alert without a link); ``scope`` what such a row takes
    down in parity mode. Every page is parsed once, by the one job that writes the table."""
    key = ["source_id", "page_id", *KEEP]
    pages, docs = E.http_failure(listing_pages), E.http_failure(feed_docs)
    good_pages, good_details = pages.where(F.col("fatal").isNull()), E.status_gate(detail_pages)
    alerts = feeds(docs.where(F.col("fatal").isNull()), good_details, partitions)
    listed = dealt(good_pages.select("source_id", "page_id", *KEEP, "html"), "page_id", partitions)
    alerts = alerts.unionByName(compile_profiles(listed, profiles, run_year), allowMissingColumns=True)
    failures = pages.where(F.col("fatal").isNotNull()).select(*key, "fatal").unionByName(docs.where(F.col("fatal").isNotNull()).select(*key, "fatal"))
    no_link = F.when(F.coalesce(F.col("url"), F.lit("")) == "", F.lit("no link"))
    alerts = alerts.withColumn("fatal", F.coalesce("fatal", no_link)).withColumn("url", F.nullif(F.col("url"), F.lit("")))
    return stored(with_scope(alerts.unionByName(failures, allowMissingColumns=True), profiles), "flagged")


def collect(listing_pages: DataFrame, feed_docs: DataFrame, detail_pages: DataFrame, run_year: int, *, parity: bool = False,
            profiles: Sequence[ProfileRow] = ROWS, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(usable alerts, quarantined rows) of :func:`flagged`; both read the written table. In parity
    mode every scope that holds a fatal row contributes nothing."""
    rows = flagged(listing_pages, feed_docs, detail_pages, run_year, profiles=profiles, partitions=partitions)
    good = E.apply_error_policy(rows, ["scope"], parity=parity).drop("scope")
    return good, rows.where(F.col("fatal").isNotNull()).drop("scope")


def content_table(routed: DataFrame, content: ContentStore | PlainContent, rules: DataFrame,
                  max_pages: int | None = None, partitions: int | None = None) -> DataFrame:
    """U3 + J4: ``content_key, content`` for routed alerts (P6): web pages under their country's rules,
    documents by their pages; of any number of fetches of a page the newest counts. What was
    fetched is cut down to the links the alerts want before anything is grouped, in a store
    without an exchange, and the result is written as one row a key."""
    want = stored(routed.select(F.col("content_key").alias("url"), "pais", "content_type").where("url IS NOT NULL").distinct(), "wanted")
    of_web, of_docs = want.where("content_type = 'html'"), want.where("content_type = 'pdf'")
    fetched = C.newest_fetch(content.web_pages(of_web.select("url").distinct()), ["url"]).select("url", "html").join(of_web.select("url", "pais"), "url")
    # an address may serve two countries: its rows are told apart by both
    fetched = fetched.select(F.to_json(F.array("url", "pais")).alias("page_id"), "url", "html", "pais")
    ruled = RU.with_rules(dealt(fetched, "page_id", partitions), rules, "pais")
    web = page_content(ruled, "page_id", keep=["url", "pais"]).select(F.col("url").alias("content_key"), "content")
    pages = content.doc_pages(of_docs.select("url").distinct())
    pages = C.newest_fetch(pages if max_pages is None else pages.where(F.col("page_no") < max_pages), ["url", "page_no"])
    docs = C.doc_first_pages(pages, "url", "page_no", "text", max_pages)
    return stored(C.one_per_key(web.unionByName(docs.withColumnRenamed("url", "content_key")).where("content is not null"), "content_key"), "content")


@dataclass
class RunResult:
    news: DataFrame
    outbox: DataFrame
    merged: DataFrame
    counters: DataFrame


def enriched_news(news: DataFrame, content: ContentStore | PlainContent, rules: DataFrame, *, summariser: C.Summariser = C.default_summariser,
                  extractive: bool = False, max_pages: int | None = None, partitions: int | None = None) -> DataFrame:
    """P6/J3 → U3/J4/P9, computed once into the shared folder: the summary a message carries is the
    one that history stores, also for a model. ``extractive``: sentences chosen from the content
    (over the run's contents) instead of a summariser."""
    routed = C.content_route(RU.with_rules(news, rules, "pais")).drop(
        "container_sel", "selectors_sel", "remove_sel", "note", "container", "selectors", "remove", "rule_error")
    texts = content_table(routed, content, rules, max_pages, partitions)
    return stored(C.enrich(routed, with_summaries(texts) if extractive else texts, summariser), "news")


def run(candidates: DataFrame, history: DataFrame, web_pages: DataFrame, doc_pages: DataFrame, rules: DataFrame, *,
        batch_id: str = "0", silent: bool = False, summariser: C.Summariser = C.default_summariser,
        max_pages: int | None = None, partitions: int | None = None) -> RunResult:
    """J1 → P6/J3 → U3/J4/P9 → K2 → A8 against a history table; nothing is stored (for that, see
    :func:`run_on`)."""
    news = stored(H.novelty(candidates, history), "novelty")
    enriched = enriched_news(news, PlainContent(web_pages, doc_pages), rules, summariser=summariser, max_pages=max_pages, partitions=partitions)
    out = N.outbox(enriched, batch_id=batch_id, silent=silent)
    merged = H.merge_history(HS.backfill(history), enriched.drop("content", "content_key", "content_type"))
    counters = H.run_counters(history, candidates, enriched, merged, enriched)
    return RunResult(enriched, out, merged, counters)


def run_on(store: AlertStore, candidates: DataFrame, content: ContentStore | PlainContent, rules: DataFrame, *,
           batch_id: str = "0", silent: bool = False, summariser: C.Summariser = C.default_summariser, extractive: bool = False, max_pages: int | None = None, partitions: int | None = None) -> int | None:
    """The whole run on a store: novelty against its links, content, summary, then the new links, the
    messages (none in silent mode) and the counters (A10) under one commit. Returns the batch, none
    if there was nothing new (K1). A run that dies anywhere before the commit can be repeated.

    Counters come from written tables, not from accumulators, which count a retried task twice."""
    news = stored(store.novelty(candidates), "novelty")
    enriched = enriched_news(news, content, rules, summariser=summariser, extractive=extractive, max_pages=max_pages, partitions=partitions)
    seen = enriched.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("chars")).first()
    counters = {"history_rows": store.state().rows, "candidate_rows": candidates.count(), "novelty_rows": seen["n"], "content_chars": seen["chars"]}
    messages = None if silent else N.outbox(enriched, batch_id=batch_id)
    return store.add(enriched, messages, counters)


def persist_history(result: RunResult, root: str) -> str | None:
    """K1: write the merged history as a new version, only when the run found something new."""
    if not result.news.limit(1).count():
        return None
    return HS.write_history_version(HS.conform(result.merged), root)


# ------------------------------------------------------------------------------ flagship

def flagship(spark: SparkSession, sf: str, summariser: C.Summariser = C.default_summariser) -> DataFrame:
    """Minimum slice (web pages as alerts): pages already in history (every third page id) are
    left out first, so only new pages are shredded; their content follows the per-language rules,
    the summary is the lead words of the content with the page title as fallback, and each new
    page gets a notification message."""
    pages = T(spark, sf, "pages").select("page_id", "url", "html")
    history = pages.where(F.col("page_id") % 3 == 0).select("url")
    news = H.novelty(pages, history).drop("resumen")
    news = news.withColumn("lang", F.regexp_extract("url", r"/([a-z]{2})/", 1))
    ruled = RU.with_rules(dealt(news, "page_id", spread(pages)), RU.rules_bundled(spark, PAGE_RULES), "lang")
    text = page_content(ruled, "page_id", keep=["url", "lang"], title_selector="title")
    alerts = text.select(
        "url", F.lit(None).cast("string").alias("pdf"), "titulo", F.col("lang").alias("fecha"),
        F.lit("Web").alias("pais"), host_of("url").alias("institucion"),
        C.summary_fallback(F.when(F.col("content").isNotNull(), summariser(F.col("content"), F.col("titulo"))),
                           F.col("titulo")).alias("resumen"))
    return N.outbox(alerts, batch_id=0)
