"""Append-only tables bucketed by a hash of their key, one partition folder a batch.

A join or a grouping on the key reads such a table bucket by bucket: its rows are never exchanged,
whatever their size; only the other side moves, dealt into as many partitions as there are
buckets. The files are plain Parquet under ``root``; each session lays an external table over
them. The number of buckets is fixed when the first batch is written (a one-row ``_layout`` table
beside the data says how many).

Which batches count is not decided here: a reader names them, so a batch that was written but
never committed is not seen, and writing a batch again replaces it.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing(e: AnalysisException) -> bool:
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class BucketedLog:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str = "url", sort: tuple[str, ...] = (), buckets: int | None = None):
        self.spark, self.root, self.schema, self.key, self.sort = spark, root.rstrip("/"), schema, key, (key, *sort)
        self.first_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "vigia_log_" + hashlib.md5(self.root.encode()).hexdigest()

    @property
    def buckets(self) -> int | None:
        """The number of buckets; none before the first batch."""
        try:
            rows = self.spark.read.schema("buckets int").parquet(self.root + "/_layout").collect()
        except AnalysisException as e:
            if missing(e):
                return None
            raise
        return rows[0][0] if rows else None

    def _table(self, buckets: int) -> str:
        """The session's table over the files, with the partitions that are there now."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"""CREATE TABLE {self.name} ({columns}, batch BIGINT) USING parquet PARTITIONED BY (batch)
            CLUSTERED BY (`{self.key}`) SORTED BY ({', '.join(f'`{c}`' for c in self.sort)}) INTO {buckets} BUCKETS LOCATION '{self.root}/data'""")
        self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return self.name

    def empty(self) -> DataFrame:
        return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())]))

    def read(self, batches: list[int] | None = None) -> DataFrame:
        """Rows of the named batches (all by default) with their ``batch``."""
        buckets = self.buckets
        if buckets is None or batches == []:
            return self.empty()
        rows = self.spark.table(self._table(buckets))
        return rows if batches is None else rows.where(F.col("batch").isin(batches))

    def files(self, batches: list[int]) -> DataFrame:
        """The same rows as plain files, for readers that have no use for the buckets."""
        if self.buckets is None or not batches:
            return self.empty()
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(schema).parquet(self.root + "/data").where(F.col("batch").isin(batches))

    def dealt(self, keys: DataFrame) -> DataFrame:
        """``keys`` (one column, the key) where the buckets are: in as many partitions, by the same
        hash. Left to itself, the planner moves the table instead where it has few buckets."""
        buckets = self.buckets
        return keys if buckets is None else keys.repartition(buckets, self.key)

    def wanted(self, keys: DataFrame) -> DataFrame:
        """Rows with one of the (distinct) ``keys``; only the keys move."""
        return self.read().drop("batch").join(self.dealt(keys), self.key, "left_semi")

    def append(self, rows: DataFrame, batch: int) -> None:
        """``rows`` (the schema's columns, by name) as batch ``batch``, replacing what it held. Rows
        are dealt by the key, one file a bucket; rows that lie in buckets already stay there."""
        buckets = self.buckets
        if buckets is None:
            buckets = self.first_buckets
            self.empty().write.mode("append").partitionBy("batch").parquet(self.root + "/data")  # the folder itself
            self.spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(self.root + "/_layout")
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        view = f"{self.name}_rows"
        rows.repartition(buckets, self.key).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self._table(buckets)} PARTITION (batch = {int(batch)}) SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def merge(self, batches: list[int], into: int) -> None:
        """The rows of ``batches`` as one new batch, bucket by bucket (nothing is exchanged)."""
        view = f"{self.name}_merge"
        self.read(batches).drop("batch").createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT INTO TABLE {self.name} PARTITION (batch = {int(into)}) SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
