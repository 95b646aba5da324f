"""Fetched content as a fetch-ordered store, newest fetch first.

Web pages (url, html) and pages of documents (url, page_no, text) are kept fetch by fetch with the
time of the fetch, bucketed by url. A batch of fetches keeps the newest row of a page when it is
written, so a url has at most one row a batch and page, however often it was fetched.

A reader names the urls it wants: the store's rows are cut down to them first, inside their
buckets, then grouped by page, again inside their buckets. No markup is exchanged, wanted or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.content import newest_fetch
from .buckets import BucketedLog

WEB_SCHEMA = T.StructType([T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("fetched_at", T.TimestampType())])
DOC_SCHEMA = T.StructType([T.StructField("url", T.StringType()), T.StructField("page_no", T.IntegerType()), T.StructField("text", T.StringType()),
                           T.StructField("fetched_at", T.TimestampType())])


class ContentStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        root = root.rstrip("/")
        self.web = BucketedLog(spark, root + "/web", WEB_SCHEMA, "url", ("fetched_at",), buckets)
        self.docs = BucketedLog(spark, root + "/docs", DOC_SCHEMA, "url", ("page_no", "fetched_at"), buckets)

    def add(self, batch: int, web: DataFrame | None = None, docs: DataFrame | None = None) -> None:
        """Fetches of one run (rows without a url are left out); the same batch again replaces it."""
        if web is not None:
            self.web.append(newest_fetch(web.where(F.col("url").isNotNull()), ["url"]), batch)
        if docs is not None:
            self.docs.append(newest_fetch(docs.where(F.col("url").isNotNull()), ["url", "page_no"]), batch)

    def web_pages(self, urls: DataFrame | None = None) -> DataFrame:
        """Fetches of the given distinct ``urls`` (of all, without): ``url, html, fetched_at``."""
        return self.web.read().drop("batch") if urls is None else self.web.wanted(urls)

    def doc_pages(self, urls: DataFrame | None = None) -> DataFrame:
        """Fetches of the given distinct ``urls`` (of all, without): ``url, page_no, text, fetched_at``."""
        return self.docs.read().drop("batch") if urls is None else self.docs.wanted(urls)


class PlainContent:
    """The same reads from two plain tables (url, html) and (url, page_no, text), with or without
    ``fetched_at``: the join with the urls is the planner's."""

    def __init__(self, web: DataFrame, docs: DataFrame):
        at = lambda df: [c for c in ("fetched_at",) if c in df.columns]
        self.web, self.docs = web.select("url", "html", *at(web)), docs.select("url", "page_no", "text", *at(docs))

    def web_pages(self, urls: DataFrame) -> DataFrame:
        return self.web.join(urls, "url", "left_semi")

    def doc_pages(self, urls: DataFrame) -> DataFrame:
        return self.docs.join(urls, "url", "left_semi")
