"""Incremental novelty with Structured Streaming.

Each micro-batch of candidate alerts goes through the batch operators (J1 novelty, P3/P9 summary,
K2 outbox, A8 first-row-per-url) inside ``foreachBatch``:

* history is a Parquet table partitioned by ``batch``; batch *b* reads only ``batch < b``
  (partition pruning), so a replayed batch sees exactly what it saw the first time;
* the rows first seen in batch *b* and its outbox messages are written with dynamic partition
  overwrite into ``batch=b`` — a replay after a failure rewrites the same partition instead of
  appending twice (idempotent sink on top of the checkpointed source offsets);
* no watermark: history never expires in the reference, a watermark would re-alert old links.

The result after any number of micro-batches equals the batch job over their union.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import content as C
from ..operators import history as H
from ..operators import notify as N


def _history_urls(spark: SparkSession, root: str, before: int) -> DataFrame:
    """Urls of earlier batches only (partition filter on ``batch``); none before the first.

    Read through Spark, so the root can be shared storage; a root not written yet raises
    PATH_NOT_FOUND when the read is planned and means no history."""
    try:
        h = spark.read.schema("url string, batch bigint").parquet(root)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "url string")
        raise
    return h.where(F.col("batch") < before).select("url")


def process_batch(batch: DataFrame, batch_id: int, history_root: str, outbox_root: str,
                  summariser: C.Summariser | None = None) -> None:
    """One micro-batch: novelty against earlier batches, outbox, history partition."""
    spark = batch.sparkSession
    cols = batch.columns
    news = H.novelty(batch, _history_urls(spark, history_root, batch_id))
    if summariser is not None and "content" in cols:
        news = news.withColumn("resumen", C.summary_fallback(summariser(F.col("content"), F.col("titulo")), F.col("titulo")))
    # computed once, with its summaries, then read back for both outputs: a model behind the
    # summariser answers once, and the message carries what history stores
    staged = outbox_root.rstrip("/") + "_news"
    _put(news, staged, batch_id)
    schema = T.StructType([*news.schema.fields, T.StructField("batch", T.LongType())])
    news = spark.read.schema(schema).parquet(staged).where(F.col("batch") == batch_id).drop("batch")
    order = [c for c in H.ORDER if c in news.columns]
    _put(H.keep_first(news, "url", order or ["titulo"]), history_root, batch_id)
    _put(N.outbox(news, batch_id=batch_id), outbox_root, batch_id)


def _put(df: DataFrame, root: str, batch_id: int) -> None:
    """Write ``df`` as partition ``batch=batch_id`` of ``root``, replacing that partition only."""
    (df.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(root))


def compact(spark: SparkSession, history_root: str, new_root: str, files: int) -> str:
    """The whole history in two partitions of ``files`` files each (a folder per micro-batch makes
    planning grow with run time): the last batch, which may be replayed, and all before it. The
    old root is only read; run it while the stream is stopped, then start on ``new_root``."""
    h = spark.read.parquet(history_root)
    last = h.agg(F.max("batch")).first()[0]
    done, rest = h.where(F.col("batch") < last), h.where(F.col("batch") == last)
    if done.limit(1).count():
        _put(done.drop("batch").repartition(files), new_root, last - 1)
    _put(rest.drop("batch").repartition(files), new_root, last)
    return new_root


def start(spark: SparkSession, source_dir: str, schema: T.StructType, history_root: str, outbox_root: str,
          checkpoint: str, available_now: bool = True, summariser: C.Summariser | None = None):
    """Start the incremental job over Parquet files dropped into ``source_dir``.

    ``checkpoint`` must be on shared storage (e.g. under ``spark.checkpoint.dir``)."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: process_batch(df, bid, history_root, outbox_root, summariser))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
