"""K3: report tables.

``prepare`` parses and filters once; the report tables are separate aggregations of it (cache
it when several are materialised in one run — the reference memoises the same frame).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import REPORT_FORMATS, report_date

# The reference's report starts at 2025-11-20 and its daily line hides days
# up to 2025-11-01. A caller who wants these passes them; by default all rows stay.
REFERENCE_MIN_DATE = dt.date(2025, 11, 20)
REFERENCE_DAY_CUTOFF = dt.date(2025, 11, 1)


def with_report_date(history: DataFrame, formats=REPORT_FORMATS) -> DataFrame:
    """T13 + D8: `fecha` (string) → `fecha` (date), null when it does not parse."""
    return history.withColumn("fecha", report_date("fecha", formats))


def prepare(history: DataFrame, min_date: dt.date | None = None, formats=REPORT_FORMATS) -> DataFrame:
    """F8: keep dates on or after ``min_date`` (nulls drop); without one every row stays."""
    dated = with_report_date(history, formats)
    return dated if min_date is None else dated.where(F.col("fecha") >= F.lit(min_date))


def select_countries(df: DataFrame, selection: list[str] | None) -> DataFrame:
    """an empty selection means all countries."""
    return df if not selection else df.where(F.col("pais").isin(list(selection)))


def kpis(df: DataFrame) -> DataFrame:
    """Total, distinct countries (nulls out), latest date as dd-MM-yyyy (null if none)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_alertas"),
        F.count_distinct("pais").alias("paises_activos"),
        F.date_format(F.max("fecha"), "dd-MM-yyyy").alias("ultima_actualizacion"),
    )


def by_country(df: DataFrame) -> DataFrame:
    """A4 + P5: count per country, descending, ties by name."""
    return (df.where(F.col("pais").isNotNull()).groupBy("pais").agg(F.count(F.lit(1)).alias("Cantidad"))
            .withColumnRenamed("pais", "País").orderBy(F.desc("Cantidad"), F.asc("País")))


def by_day(df: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    """A5 + F10: alerts per date, days after ``cutoff`` if one is given, sorted by date."""
    days = df.groupBy("fecha").agg(F.count(F.lit(1)).alias("Alertas"))
    return (days if cutoff is None else days.where(F.col("fecha") > F.lit(cutoff))).orderBy("fecha")


def countries(df: DataFrame) -> DataFrame:
    """Distinct countries, sorted (null out)."""
    return df.where(F.col("pais").isNotNull()).select("pais").distinct().orderBy("pais")


def detail(df: DataFrame) -> DataFrame:
    """O1 + P5: newest first (ties by url), date shown DD-MM-YYYY."""
    return (df.orderBy(F.desc("fecha"), F.asc("url"))
            .select(F.date_format("fecha", "dd-MM-yyyy").alias("fecha"), "pais", "institucion", "titulo", "url"))
