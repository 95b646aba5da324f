"""J1 / P3 / A8 / A9 / U-3 / A10: novelty against history, merges and dedupes.

All dedupes are grouped aggregations with ``min_by``/``max_by`` over an explicit order key, not
window ``row_number``: the aggregation combines map-side before the shuffle, so one url holding
a third of all rows costs one partial row per task instead of one giant window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Position of an alert: source, category, page, place in the page (columns a table lacks are skipped).
ORDER = ("source_rank", "categoria_rank", "page_id", "item_pos")


def novelty(candidates: DataFrame, history: DataFrame, key: str = "url") -> DataFrame:
    """J1 + P3: candidates whose key is not in history; in-batch duplicates stay.

    ``left_anti`` against the history keys (never ``NOT IN``: one null key would empty the
    result). The keys are not made distinct first: an aggregate between exchange and join would
    keep AQE from splitting a skewed candidate key. AQE picks broadcast when the key set is
    measured small at runtime.
    """
    keys = history.select(key).where(F.col(key).isNotNull())
    out = candidates.join(keys, on=key, how="left_anti")
    if "resumen" not in out.columns and "titulo" in out.columns:
        out = out.withColumn("resumen", F.col("titulo"))
    return out


def keep_first(df: DataFrame, key: str, order: list[str], cols: list[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple."""
    cols = cols or [c for c in df.columns if c != key]
    ordkey = F.struct(*[F.col(c) for c in order])
    rec = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(key).agg(F.min_by(rec, ordkey).alias("_r"))
            .select(key, "_r.*"))


def merge_history(history: DataFrame, news: DataFrame, key: str = "url",
                  order: tuple[str, ...] = ORDER) -> DataFrame:
    """A8 + U-3: history ∪ novelty, one row per key; history wins, then batch order."""
    h = history.withColumn("_is_new", F.lit(0))
    n = news.withColumn("_is_new", F.lit(1))
    u = h.unionByName(n, allowMissingColumns=True)
    cols = [c for c in u.columns if c not in (key,)]
    out = keep_first(u, key, ["_is_new", *[o for o in order if o in u.columns]], cols)
    return out.drop("_is_new")


def dedupe_last(df: DataFrame, key: str = "url", order: tuple[str, ...] = ORDER) -> DataFrame:
    """A9 + F6: per key the last row's values win, at the first row's position; empty keys out.

    Rows are ordered by the columns of ``order`` that ``df`` has."""
    pos = [c for c in order if c in df.columns]
    cols = [c for c in df.columns if c not in (key, *pos)]
    rec = F.struct(*[F.col(c) for c in cols])
    return (df.where(F.col(key).isNotNull() & (F.col(key) != ""))
            .groupBy(key)
            .agg(F.max_by(rec, F.struct(*pos)).alias("_r"), F.min(F.struct(*pos)).alias("_p"))
            .select(key, "_r.*", "_p.*"))


def run_counters(history: DataFrame, candidates: DataFrame, news: DataFrame, merged: DataFrame,
                 content: DataFrame | None = None) -> DataFrame:
    """A10: the console counters of a run as one row.

    Each stage contributes (name, value) partial counts; a union and one conditional
    aggregation folds them into a single row (no joins of the stage results).
    """
    def stage(df: DataFrame, name: str, value=None) -> DataFrame:
        v = F.lit(1) if value is None else value
        return df.select(F.lit(name).alias("counter"), v.cast("bigint").alias("v"))

    parts = [stage(history, "history_rows"), stage(candidates, "candidate_rows"),
             stage(news, "novelty_rows"), stage(merged, "updated_rows")]
    names = ["history_rows", "candidate_rows", "novelty_rows", "updated_rows"]
    if content is not None:
        parts.append(stage(content, "content_chars", F.coalesce(F.length("content"), F.lit(0))))
        names.append("content_chars")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.coalesce(F.sum(F.when(F.col("counter") == n, F.col("v"))), F.lit(0)).cast("bigint").alias(n) for n in names])
