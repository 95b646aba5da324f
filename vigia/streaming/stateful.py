"""Incremental novelty on a state store.

Which links were seen is streaming state, keyed by link, kept in RocksDB beside the stream's
checkpoint: the store's history enters once, as the initial state of a new stream, and no
micro-batch reads it again. State has no time limit and there is no watermark: history never
expires, and a forgotten link would be alerted twice.

Rows of a link that is new to the state leave together, in-batch duplicates included (each is
notified); each micro-batch is one commit of the alert store under the stream's name and batch
number, so a batch that is replayed after a failure finds its commit and writes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import content as C
from ..operators import notify as N
from ..sources.alert_store import AlertStore

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class UnseenLinks(StatefulProcessor):
    """Passes all rows of a key on when the key is met for the first time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        if not self.seen.exists():
            self.seen.update((True,))
            yield from rows

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.seen.update((True,))

    def close(self) -> None:
        pass


def unseen(stream: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``stream`` whose ``url`` is neither in ``known`` nor in an earlier micro-batch. ``known``
    is not read bucket by bucket: the planner takes as many buckets as state partitions for dealt
    out already, and then reads them split by split."""
    return stream.where(F.col("url").isNotNull()).groupBy("url").transformWithState(
        UnseenLinks(), stream.schema, "Append", "None", initialState=known.select("url").groupBy("url"))


def commit_batch(store: AlertStore, news: DataFrame, run: str, summariser: C.Summariser | None = None) -> int | None:
    """P3 / P9, A8, K2 and K1 of one micro-batch, under one commit named ``run``."""
    if "resumen" not in news.columns:
        news = news.withColumn("resumen", F.col("titulo"))
    if summariser is not None and "content" in news.columns:
        news = news.withColumn("resumen", C.summary_fallback(summariser(F.col("content"), F.col("titulo")), F.col("titulo")))
    path = f"{store.root}/_staged/{run}"  # computed once: the message carries what history stores
    news.write.mode("overwrite").parquet(path)
    news = store.spark.read.schema(news.schema).parquet(path)
    return store.add(news, N.outbox(news, batch_id=run), run=run)


def start(spark: SparkSession, source_dir: str, schema: T.StructType, store: AlertStore, checkpoint: str, name: str = "stream",
          available_now: bool = True, summariser: C.Summariser | None = None) -> StreamingQuery:
    """Candidates dropped as Parquet files into ``source_dir`` → commits of ``store``.

    ``checkpoint`` must be on shared storage; ``name`` tells the commits of one stream from others'
    and stays the same as long as the checkpoint is kept."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # keyed state needs it
    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = unseen(stream, store.links()).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch: commit_batch(store, df, f"{name}-{batch}", summariser) and None)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
