"""Properties of the history operators and plan independence from partitioning."""
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from vigia.operators import history as H
from vigia.plans import standins as S


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def _alerts(spark):
    return S._event_alerts(spark, SF_CHECK).drop("user_id")


def test_merge_idempotent_and_novelty_empty(spark):
    b = _alerts(spark)
    h = S._event_history(spark, SF_CHECK)
    m1 = H.merge_history(h, H.novelty(b, h))
    cols = ["url", "titulo", "item_pos"]
    m2 = H.merge_history(m1, H.novelty(b, m1))
    assert rows(m1.select(cols)) == rows(m2.select(cols))
    assert H.novelty(b, m1).count() == 0


def test_dedupe_first_last(spark):
    df = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("a", "3", 3), ("", "x", 4)], "url string, v string, item_pos long")
    first = rows(H.keep_first(df.where("url <> ''"), "url", ["item_pos"]))
    last = rows(H.dedupe_last(df))
    assert first == [("a", "1", 1), ("b", "2", 2)]
    assert last == [("a", "3", 1), ("b", "2", 2)]


def test_result_independent_of_partitioning(spark):
    a = rows(S.q_html_content(spark, SF_CHECK))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = rows(S.q_html_content(spark, SF_CHECK))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_input_order_does_not_matter(spark):
    b = _alerts(spark)
    shuffled = b.orderBy(F.rand(7))
    assert rows(H.dedupe_last(b.select("url", "titulo", "item_pos"))) == rows(H.dedupe_last(shuffled.select("url", "titulo", "item_pos")))
