"""The alert history table.

The reference keeps history as a CSV with a header, infers types on every read and patches
missing columns. Here history has an explicit schema; CSV import/export is kept for interop,
Parquet is the working format, and writes go to a new version folder (Spark cannot overwrite a
path it is reading from), then a small pointer file names the current version.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALERT_SCHEMA = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("pdf", T.StringType()),
    T.StructField("titulo", T.StringType()),
    T.StructField("fecha", T.StringType()),
    T.StructField("fecha_ts", T.TimestampType()),
    T.StructField("pais", T.StringType()),
    T.StructField("institucion", T.StringType()),
    T.StructField("resumen", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("source_rank", T.IntegerType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("categoria_rank", T.IntegerType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("item_pos", T.LongType()),
    T.StructField("error", T.StringType()),
])

# Columns of a history file written by the reference (all strings); `pdf` appears once a
# Peru row was merged.
HISTORY_CSV_COLUMNS = ["url", "titulo", "fecha", "pais", "institucion", "resumen", "pdf"]
HISTORY_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in HISTORY_CSV_COLUMNS])

# Defaults for history written before these columns existed.
BACKFILL = {"resumen": "", "pais": "Desconocido"}


def empty_history(spark: SparkSession) -> DataFrame:
    """Missing history: an empty table with the six reference columns."""
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in HISTORY_CSV_COLUMNS[:6]]))


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header; quotes and newlines inside fields survive (multiLine, escape '"').
    Only the empty field is null (pandas would also read 'NA'). Missing path → empty table."""
    try:
        header = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        cols = header.columns
    except AnalysisException as e:
        if _missing(e):
            return empty_history(spark)
        raise
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("enforceSchema", False).csv(path))


def backfill(df: DataFrame) -> DataFrame:
    """Add `resumen` = '' and `pais` = 'Desconocido' when the columns are absent."""
    for c, v in BACKFILL.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(v))
    return df


def conform(df: DataFrame, schema: T.StructType = ALERT_SCHEMA) -> DataFrame:
    """Fixed schema: missing columns null, extra columns out, types cast."""
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def write_history_csv(df: DataFrame, path: str) -> None:
    """Export in the reference's layout (header, no index column)."""
    cols = [c for c in HISTORY_CSV_COLUMNS if c in df.columns]
    (df.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


# ---- versioned Parquet history -------------------------------------------------------------

def _versions(root: str) -> str:
    return root.rstrip("/") + "/_versions"


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The last committed version: the newest row of the small ``_versions`` table (one row per
    run, read through Spark so the root can be shared storage); none before the first commit."""
    try:
        vs = spark.read.schema("version string, seq long").parquet(_versions(root))
    except AnalysisException as e:
        if _missing(e):
            return None
        raise
    rows = vs.orderBy(F.desc("seq"), F.desc("version")).limit(1).collect()
    return rows[0]["version"] if rows else None


def read_history(spark: SparkSession, root: str) -> DataFrame:
    v = current_version(spark, root)
    if v is None:
        return conform(spark.createDataFrame([], ALERT_SCHEMA))
    return spark.read.parquet(root.rstrip("/") + "/" + v)


def write_history_version(df: DataFrame, root: str) -> str:
    """K1: write the merged table as a new version folder, then commit it by appending one row
    to ``_versions``. Each write is one Spark job with its own atomic commit: a run that dies
    before the append leaves the previous version current, and nothing read is overwritten."""
    spark = df.sparkSession
    v = f"v-{uuid.uuid4().hex[:12]}"
    df.write.mode("error").parquet(root.rstrip("/") + "/" + v)
    spark.createDataFrame([(v, time.time_ns())], "version string, seq long") \
        .coalesce(1).write.mode("append").parquet(_versions(root))
    return v
