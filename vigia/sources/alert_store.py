"""K1 + K2: the alert history and the outbox as one store with one commit.

* History is append-only: a run writes the first row of every new link as one batch, bucketed by
  the link; links of other batches are never read back to be written again. As every batch holds
  only links that no committed batch has, the history is the plain union of its batches.
* The outbox of a run is a batch of its own.
* One commit row names both (and the counters of the run). A batch that no commit names does not
  exist: a run that dies between its writes neither stores a link nor sends a message, and the
  next run finds the same news again, under a new batch number.
* ``compact`` merges history batches into one, in its own commit, bucket by bucket.

One run writes to a store at a time; a commit whose number was taken meanwhile raises.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import history as H
from ..session import checkpoint_dir
from .buckets import BucketedLog, missing
from .history import ALERT_SCHEMA, backfill, conform, read_history_csv

COMMIT_SCHEMA = "seq long, run string, added array<long>, dropped array<long>, sent array<long>, counters map<string,long>"


@dataclass
class State:
    """What the commits so far say: the last number, live history batches, batches of messages."""
    seq: int = 0
    history: list[int] = field(default_factory=list)
    outbox: list[int] = field(default_factory=list)
    rows: int = 0


class AlertStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = BucketedLog(spark, self.root + "/history", ALERT_SCHEMA, "url", buckets=buckets)

    # ---- commits

    def commits(self) -> DataFrame:
        """One row a commit, in order."""
        try:
            rows = self.spark.read.schema(COMMIT_SCHEMA).parquet(self.root + "/_commits")
            return rows.orderBy("seq")
        except AnalysisException as e:
            if missing(e):
                return self.spark.createDataFrame([], COMMIT_SCHEMA)
            raise

    def state(self) -> State:
        """The commits folded (one small row a run)."""
        out = State()
        for c in self.commits().collect():
            out.seq = c["seq"]
            rest = [b for b in out.history if b not in c["dropped"]]
            out.history = [*c["added"], *rest] if c["dropped"] else [*rest, *c["added"]]  # what was merged is older than the rest
            out.outbox += list(c["sent"])
            out.rows += (c["counters"] or {}).get("stored_rows", 0)
        return out

    def _commit(self, seq: int, added: list[int], dropped: list[int], sent: list[int], counters: dict[str, int], run: str | None = None) -> None:
        run = run or uuid.uuid4().hex
        one = self.spark.createDataFrame([(seq, run, added, dropped, sent, counters)], COMMIT_SCHEMA)
        one.coalesce(1).write.mode("append").parquet(self.root + "/_commits")
        if self.commits().where(F.col("seq") == seq).count() > 1:
            raise RuntimeError(f"commit {seq} of {self.root} was written by two runs")

    def _next_batch(self, seq: int) -> int:
        """A number no other run uses, not even one that died after writing under it."""
        return (seq << 32) | (uuid.uuid4().int & 0xFFFFFFFF)

    # ---- reads

    def history(self) -> DataFrame:
        return self.log.read(self.state().history).drop("batch")

    def links(self) -> DataFrame:
        """The distinct links of the history, ``url``, as a plain scan of one column."""
        return self.log.files(self.state().history).select("url")

    def outbox(self) -> DataFrame:
        """Messages of committed runs: ``url, message, batch_id``, and their ``batch``."""
        schema = "url string, message string, batch_id string, batch long"
        sent = self.state().outbox
        if not sent:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.root + "/outbox").where(F.col("batch").isin(sent))

    def fresh_links(self, candidates: DataFrame, key: str = "url") -> DataFrame:
        """The distinct links of ``candidates`` that no committed batch has. They move to the buckets;
        the history, links only, is read where it lies, and gives the few that it knows. (A direct
        anti join would be pushed below the move of the links, and then move the history.)"""
        links = candidates.select(F.col(key).alias("url")).where(F.col("url").isNotNull()).distinct()
        seen = self.log.read(self.state().history).select("url").join(self.log.dealt(links), "url", "left_semi")
        return links.join(seen, "url", "left_anti")

    def novelty(self, candidates: DataFrame) -> DataFrame:
        """J1 + P3: candidates with a fresh link; duplicates inside the batch stay. The fresh links are
        written first, so the join back can be split where one link has a large share of the rows."""
        path = f"{checkpoint_dir(self.spark)}/vigia-job/fresh-{uuid.uuid4().hex}"
        self.fresh_links(candidates).write.parquet(path)
        out = candidates.join(self.spark.read.schema("url string").parquet(path), "url", "left_semi")
        return out if "resumen" in out.columns or "titulo" not in out.columns else out.withColumn("resumen", F.col("titulo"))

    # ---- writes

    def add(self, news: DataFrame, messages: DataFrame | None = None, counters: dict[str, int] | None = None, run: str | None = None) -> int | None:
        """Store ``news`` (rows with fresh links; the first of each link is kept, A8) and their
        ``messages``, under one commit. Returns the batch, none if there is no news (K1). A ``run``
        that has its commit already (a micro-batch replayed) changes nothing."""
        done = self.commits().where(F.col("run") == run).collect() if run else []
        if done:
            return done[0]["added"][0]
        seq = self.state().seq + 1
        batch = self._next_batch(seq)
        order = [c for c in H.ORDER if c in news.columns]
        first = H.keep_first(conform(news.where(F.col("url").isNotNull())), "url", order or ["titulo"])
        self.log.append(first, batch)
        stored = self.log.read([batch]).count()
        if not stored:
            return None
        if messages is not None:
            messages.select("url", "message", F.col("batch_id").cast("string").alias("batch_id"), F.lit(batch).cast("long").alias("batch")).write.mode(
                "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.root + "/outbox")
        self._commit(seq, [batch], [], [batch] if messages is not None and not messages.isEmpty() else [], (counters or {}) | {"stored_rows": stored}, run)
        return batch

    def import_csv(self, path: str) -> int | None:
        """S7 + P2: history files of the older layout as one batch, missing columns filled. A one-off: a
        file with line breaks inside fields is read by one task; from then on history is bucketed
        Parquet. Links that the store has already, and rows without one, are left out; a missing
        path imports nothing."""
        rows = backfill(read_history_csv(self.spark, path)).where(F.col("url") != "")
        return self.add(self.novelty(rows))

    def compact(self, keep: int = 1) -> int | None:
        """All live history batches but the last ``keep`` as one; none if there is nothing to merge.
        Their old folders are no longer read."""
        state = self.state()
        old = state.history[:-keep] if keep else state.history
        if len(old) < 2:
            return None
        seq = state.seq + 1
        batch = self._next_batch(seq)
        self.log.merge(old, batch)
        self._commit(seq, [batch], old, [], {})
        return batch
