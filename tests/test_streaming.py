"""Two micro-batches give the batch answer; a replayed batch changes nothing."""
import os

from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from vigia.operators import history as H
from vigia.streaming.incremental import compact, process_batch, start


def alerts(spark, lo, hi):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet").where((F.col("doc_id") >= lo) & (F.col("doc_id") < hi))
    return d.select(F.concat(F.lit("doc://"), (F.col("doc_id") % 700).cast("string")).alias("url"),
                    F.concat(F.col("source"), F.lit(" #"), F.col("doc_id").cast("string")).alias("titulo"),
                    F.col("lang").alias("fecha"), F.lit("Perú").alias("pais"), F.col("source").alias("institucion"),
                    F.lit(1).alias("source_rank"), F.col("doc_id").alias("item_pos"))


def test_two_batches_equal_one(spark, scratch):
    src, hist, box, ckpt = (os.path.join(scratch, x) for x in ("in", "hist", "box", "ckpt"))
    b1, b2 = alerts(spark, 0, 600), alerts(spark, 400, 1000)
    schema = b1.schema
    b1.write.parquet(os.path.join(src, "b1"))
    q = start(spark, os.path.join(src, "*"), schema, hist, box, ckpt)
    q.awaitTermination()
    b2.write.parquet(os.path.join(src, "b2"))
    q = start(spark, os.path.join(src, "*"), schema, hist, box, ckpt)
    q.awaitTermination()

    streamed = {(r.url, r.titulo) for r in spark.read.parquet(hist).select("url", "titulo").collect()}
    everything = b1.unionByName(b2)
    batch = {(r.url, r.titulo) for r in H.merge_history(spark.createDataFrame([], "url string"), everything)
             .select("url", "titulo").collect()}
    assert streamed == batch and len(batch) == 700
    # outbox: every novelty row of each batch, in-batch duplicates kept
    n_box = spark.read.parquet(box).count()
    assert n_box == 600 + alerts(spark, 600, 700).count()

    # compacted, the history holds the same rows, and a replay of the last batch changes nothing
    small = compact(spark, hist, os.path.join(scratch, "hist2"), files=1)
    assert len([d for d in os.listdir(small) if d.startswith("batch=")]) == 2
    process_batch(b2, 1, small, os.path.join(scratch, "box2"))
    assert {(r.url, r.titulo) for r in spark.read.parquet(small).select("url", "titulo").collect()} == batch
    process_batch(b2.limit(0), 2, small, os.path.join(scratch, "box3"))
    assert spark.read.parquet(small).count() == 700

    # replay of the first batch: same partition rewritten, nothing appended
    process_batch(b1, 0, hist, box)
    assert {(r.url, r.titulo) for r in spark.read.parquet(hist).select("url", "titulo").collect()} == batch
