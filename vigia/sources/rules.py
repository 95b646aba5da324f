"""Extraction rules per key (country or page language) as a small table.

Rules are read from JSON ``{key: {content_type, container?, selectors?[], remove_selectors?[],
note?}}`` with ``from_json`` to a map and exploded; selectors are tokenised once, in the rules table, by the
parser that literal selectors use (comma groups and attribute tests included). A selector that
parser does not support is an error of its rule, never another match. A missing file gives an
empty table: defaults apply. Joins leave the choice of strategy to the measured sizes.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.select import CHAIN, chain_literal, parse_selector

RULE_VALUE = ("map<string, struct<content_type: string, container: string, selectors: array<string>, "
              "remove_selectors: array<string>, note: string>>")

# Defaults when a key has no entry or an entry leaves a list out.
DEFAULT_CONTENT_TYPE = "pdf"
DEFAULT_SELECTORS = ["article", "main", "div.content"]
DEFAULT_REMOVE = ["script", "style", "nav", "footer"]

# The per-country extraction rules of the alert sources.
COUNTRY_RULES = {
    "Argentina": {
        "content_type": "html",
        "selectors": [".title-description h1", ".news__lead p", "time", ".col-md-12 div p", ".col-md-12 div ul li"],
        "remove_selectors": ["script", ".news__social-share", ".sr-only", "footer"],
    },
    "Brasil": {
        "content_type": "html",
        "container": "div.bodyModel",
        "selectors": ["div h4", "div p"],
        "remove_selectors": ["script", "style", "br", "a"],
    },
    "Bolivia": {"content_type": "pdf", "note": "Most PDFs are images, text extraction may fail"},
    "Chile": {"content_type": "pdf", "note": "HTML redirects to PDF"},
    "Colombia": {"content_type": "pdf"},
    "Costa Rica": {"content_type": "pdf"},
    "México": {"content_type": "pdf"},
    "Perú": {"content_type": "pdf", "note": "Use PDF link from scraper, not HTML"},
}


_PARSED = T.StructType([T.StructField("chains", T.ArrayType(CHAIN)), T.StructField("error", T.StringType())])


def _parse(selectors: list[str] | None) -> tuple | None:
    if selectors is None:
        return None
    chains, errors = [], []
    for sel in selectors:
        try:
            found = parse_selector(sel or "")
            if not found or any(c.attrs for c in found):
                raise ValueError(f"unsupported selector {sel!r} in a rule")
            chains += [[(tag, list(classes), cls) for tag, classes, cls in c.steps] for c in found]
        except ValueError as e:
            errors.append(str(e))
    return chains, "; ".join(errors) or None


def tokenised(rules: DataFrame) -> DataFrame:
    """Rules with their selectors as chains (``container``, ``selectors``, ``remove``) and
    ``rule_error``: what the parser does not support, which then matches nothing. A small Python
    helper over the rules table (one row a key), never over pages."""
    parse = F.udf(lambda selectors: _parse(selectors), _PARSED)
    r = rules.select("*", parse("selectors_sel").alias("_s"), parse("remove_sel").alias("_m"),
                     parse(F.when(F.col("container_sel").isNotNull(), F.array("container_sel"))).alias("_c"))
    many = F.when(F.size("_c.chains") > 1, F.concat(F.lit("a container is one chain: "), F.col("container_sel")))
    # a container that cannot be read matches no element: the page has no content, not all of it
    none = F.array(F.struct(F.lit("").alias("tag"), F.array().cast("array<string>").alias("classes"), F.lit("").alias("cls"))).cast(CHAIN)
    chain = F.when(F.col("_c.error").isNotNull() | many.isNotNull(), none).otherwise(F.try_element_at("_c.chains", F.lit(1)))
    error = F.nullif(F.concat_ws("; ", "_s.error", "_m.error", "_c.error", many), F.lit(""))
    return r.select(*rules.columns, F.when(F.col("container_sel").isNotNull(), chain).alias("container"),
                    F.col("_s.chains").alias("selectors"), F.col("_m.chains").alias("remove"), error.alias("rule_error"))


def rule_errors(rules: DataFrame) -> DataFrame:
    """``key, error`` of the rules that hold a selector the parser does not support."""
    return tokenised(rules).where(F.col("rule_error").isNotNull()).select("key", F.col("rule_error").alias("error"))


def rules_from_json_text(text_df: DataFrame, col: str = "value") -> DataFrame:
    """One JSON document per row → one rule row per key."""
    m = F.from_json(F.col(col), RULE_VALUE)
    return (text_df.select(F.explode(m).alias("key", "r"))
            .select("key", F.col("r.content_type").alias("content_type"),
                    F.col("r.container").alias("container_sel"),
                    F.col("r.selectors").alias("selectors_sel"),
                    F.col("r.remove_selectors").alias("remove_sel"),
                    F.col("r.note").alias("note")))


def rules_scan(spark: SparkSession, path: str) -> DataFrame:
    """Read a rules file; unreadable or missing → empty table (defaults apply)."""
    try:
        # the read itself fails on a missing path (shared storage included; no driver-local check)
        df = rules_from_json_text(spark.read.text(path, wholetext=True))
        df.schema  # resolve now
        return df
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return rules_from_json_text(spark.createDataFrame([], "value string"))


def rules_bundled(spark: SparkSession, path: str) -> DataFrame:
    """Rules shipped inside the package: executors of a cluster cannot see the driver's files,
    so the (small, bounded) file is read on the driver and becomes the same table as a scan."""
    with open(path, encoding="utf-8") as fh:
        rules = json.load(fh)
    return rules_from_dict(spark, rules)


def rules_from_dict(spark: SparkSession, rules: dict) -> DataFrame:
    """Rules given in code (the country rules above) → the same table as a scan."""
    return rules_from_json_text(spark.createDataFrame([(json.dumps(rules, ensure_ascii=False),)], "value string"))


def _default_chains(selectors: list[str]) -> Column:
    return F.array(*[chain_literal(c) for s in selectors for c in parse_selector(s)])


def with_rules(df: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Attach rules, tokenised beforehand, by key with defaults. No strategy is forced: a small
    rules table is broadcast on its measured size, a large one joins by shuffle."""
    out = df.join(tokenised(rules).withColumnRenamed("key", key), on=key, how="left")
    return (out
            .withColumn("content_type", F.coalesce(F.col("content_type"), F.lit(DEFAULT_CONTENT_TYPE)))
            .withColumn("selectors_sel", F.coalesce(F.col("selectors_sel"), F.array(*[F.lit(s) for s in DEFAULT_SELECTORS])))
            .withColumn("remove_sel", F.coalesce(F.col("remove_sel"), F.array(*[F.lit(s) for s in DEFAULT_REMOVE])))
            .withColumn("selectors", F.coalesce(F.col("selectors"), _default_chains(DEFAULT_SELECTORS)))
            .withColumn("remove", F.coalesce(F.col("remove"), _default_chains(DEFAULT_REMOVE))))
