"""CSV import/export with quotes and newlines, missing file, versioned Parquet history."""
import os

from pyspark.sql import functions as F

from vigia.operators import history as H
from vigia.sources import history as HS


def test_csv_round_trip_quotes_newlines(spark, scratch):
    rows = [("u1", 'say "hi", ok', "01-02-2025", "Perú", "DIGEMID", "", None),
            ("u2", "line one\nline two", "Sin Fecha", "Chile", "ISPCH", "r", "  x.pdf  ")]
    df = spark.createDataFrame(rows, HS.HISTORY_CSV_SCHEMA)
    path = os.path.join(scratch, "hist.csv")
    HS.write_history_csv(df, path)
    back = HS.read_history_csv(spark, path)
    assert sorted(back.columns) == sorted(HS.HISTORY_CSV_COLUMNS)
    got = {r.url: r for r in back.collect()}
    assert got["u1"].titulo == 'say "hi", ok' and got["u2"].titulo == "line one\nline two"
    assert got["u2"].pdf == "  x.pdf  "        # surrounding spaces survive the writer


def test_missing_history_is_empty(spark, scratch):
    df = HS.read_history_csv(spark, os.path.join(scratch, "nope.csv"))
    assert df.count() == 0 and df.columns == HS.HISTORY_CSV_COLUMNS[:6]


def test_backfill_only_missing_columns(spark):
    df = spark.createDataFrame([("u", "t")], "url string, titulo string")
    out = HS.backfill(df).first()
    assert out.resumen == "" and out.pais == "Desconocido"
    kept = HS.backfill(spark.createDataFrame([("u", "x", "y")], "url string, resumen string, pais string")).first()
    assert kept.resumen == "x" and kept.pais == "y"


def test_versioned_history_write(spark, scratch):
    root = os.path.join(scratch, "history")
    assert HS.read_history(spark, root).count() == 0
    b1 = spark.createDataFrame([("a", "t1", 1, 1), ("b", "t2", 1, 2)], "url string, titulo string, source_rank int, item_pos long")
    v1 = HS.write_history_version(H.merge_history(HS.read_history(spark, root).select("url", "titulo", "source_rank", "item_pos"), b1), root)
    # the next run reads version 1 and writes version 2 (never the folder it reads)
    b2 = spark.createDataFrame([("a", "new", 1, 3), ("c", "t3", 1, 4)], "url string, titulo string, source_rank int, item_pos long")
    h1 = HS.read_history(spark, root)
    news = H.novelty(b2, h1)
    v2 = HS.write_history_version(H.merge_history(h1, news.drop("resumen")), root)
    assert v1 != v2 and HS.current_version(spark, root) == v2
    got = {r.url: r.titulo for r in HS.read_history(spark, root).collect()}
    assert got == {"a": "t1", "b": "t2", "c": "t3"}


def test_uncommitted_version_is_ignored(spark, scratch):
    # a run that wrote its version folder but died before the commit row leaves the old version
    root = os.path.join(scratch, "history2")
    b1 = spark.createDataFrame([("a", "t1", 1, 1)], "url string, titulo string, source_rank int, item_pos long")
    v1 = HS.write_history_version(H.merge_history(HS.read_history(spark, root).select("url", "titulo", "source_rank", "item_pos"), b1), root)
    spark.createDataFrame([("z", "t9")], "url string, titulo string").write.parquet(os.path.join(root, "v-crashed"))
    assert HS.current_version(spark, root) == v1
    assert [r.url for r in HS.read_history(spark, root).collect()] == ["a"]
