"""X1 on a state store: batches against the batch job, restarts, replays, no second read of the history."""
import os

import pytest
from pyspark.sql import functions as F

from vigia.operators import history as H
from vigia.sources.alert_store import AlertStore
from vigia.streaming import stateful

SCHEMA = "url string, titulo string, fecha string, pais string, institucion string, source_rank int, item_pos long"


def alerts(spark, lo, hi, mod=70):
    return spark.range(lo, hi).select(F.concat(F.lit("u"), F.col("id") % mod).alias("url"), F.concat(F.lit("t"), F.col("id")).alias("titulo"), F.lit("f").alias("fecha"),
                                      F.lit("Chile").alias("pais"), F.lit("i").alias("institucion"), F.lit(1).alias("source_rank"), F.col("id").alias("item_pos"))


@pytest.fixture(params=[2, 8])  # fewer buckets than state partitions, and as many
def stream(spark, scratch, request):
    store = AlertStore(spark, f"{scratch}/store", buckets=request.param)
    store.add(spark.createDataFrame([("u3", "old"), ("u64", "old")], "url string, titulo string"))

    def feed(rows):
        rows.write.mode("append").parquet(f"{scratch}/in")
        query = stateful.start(spark, f"{scratch}/in", rows.schema, store, f"{scratch}/checkpoint")
        query.awaitTermination()
        return query

    return store, feed


def test_batches_with_restarts_equal_one_batch(spark, stream):
    store, feed = stream
    feed(alerts(spark, 0, 60))
    feed(alerts(spark, 40, 100).unionByName(spark.createDataFrame([(None, "no link", "f", "Chile", "i", 1, 1000)], SCHEMA)))
    both = alerts(spark, 0, 60).unionByName(alerts(spark, 60, 100))
    want = {r.url: r.titulo for r in H.keep_first(both, "url", ["item_pos"]).collect()} | {"u3": "old", "u64": "old"}
    assert {r.url: r.titulo for r in store.history().collect()} == want and store.history().count() == 70
    sent = [r.url for r in store.outbox().collect()]
    assert len(sent) == 68 and "u3" not in sent and "u64" not in sent
    assert [r.run for r in store.commits().collect()][1:] == ["stream-0", "stream-1"]


def test_no_batch_reads_the_history_again(spark, stream, monkeypatch):
    store, feed = stream
    feed(alerts(spark, 0, 10))
    read, real = [], store.log.read
    monkeypatch.setattr(store.log, "read", lambda batches=None: (read.append(batches), real(batches))[1])
    monkeypatch.setattr(store, "links", lambda: spark.createDataFrame([], "url string"))  # a restart does not need it either
    feed(alerts(spark, 5, 20))
    monkeypatch.undo()
    assert all(len(b) == 1 for b in read) and store.history().count() == 21  # only the batch just written is counted


def test_duplicates_of_one_batch_are_each_sent(spark, stream):
    store, feed = stream
    feed(alerts(spark, 0, 20, mod=5).where("url <> 'u3'"))
    assert sorted(r.url for r in store.outbox().collect()) == sorted(f"u{k}" for k in (0, 1, 2, 4) for _ in range(4))
    assert {r.url: r.titulo for r in store.history().where("titulo <> 'old'").collect()} == {f"u{k}": f"t{k}" for k in (0, 1, 2, 4)}


def test_a_replayed_batch_changes_nothing(spark, stream):
    store, feed = stream
    feed(alerts(spark, 0, 10))
    before = store.state()
    stateful.commit_batch(store, alerts(spark, 0, 10).where("url <> 'u3'"), "stream-0")
    assert store.state() == before and store.history().count() == 11
    assert stateful.commit_batch(store, alerts(spark, 0, 0), "stream-1") is None and store.state() == before


def test_a_batch_that_died_before_its_commit_is_replayed(spark, scratch, stream, monkeypatch):
    store, feed = stream

    def die(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", die)
        with pytest.raises(Exception, match="killed"):
            feed(alerts(spark, 0, 10))
    assert store.history().count() == 2 and store.outbox().count() == 0
    feed(alerts(spark, 10, 12))
    assert sorted(r.url for r in store.outbox().collect()) == sorted(f"u{k}" for k in range(12) if k != 3)
    assert os.path.isdir(f"{scratch}/checkpoint/state")
