"""The job over rendered fetches: every alert of Chile is sent, and linkless items are quarantined."""
import datetime as dt

import pytest

from vigia.plans import job_tables as J


@pytest.fixture
def sf(spark, scratch):
    rows = [(k, k + 100, "O", dt.date(1998, 1, 1), "1-URGENT") for k in range(320 * 2)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date, o_orderpriority string").write.parquet(scratch + "/orders.parquet")
    return scratch


def test_every_alert_of_chile_is_sent_and_stored(spark, sf):
    want = {f"{J.CHILE}{k}/" for k in range(1, 640, 8) if k % 3}
    assert any(k % 19 == 0 and k % 3 for k in range(1, 640, 8))
    sent = [r.url for r in J.q_job_outbox(spark, sf).where(f"url LIKE '{J.CHILE}%'").collect()]
    assert len(sent) == len(want) and set(sent) == want
    kept = J.q_job_history(spark, sf).where(f"url LIKE '{J.CHILE}%' AND pais = 'Chile'").collect()
    assert {r.url for r in kept} == want


def test_linkless_items_are_quarantined_beside_them(spark, sf):
    bare = sum(1 for k in range(1, 640, 8) if k % 19 == 0)
    _, bad = J._collected(spark, sf, every_link=True)
    assert bad.where("fatal = 'no link'").count() == bare
    assert J.q_job_quarantine(spark, sf).where("error = 'no link'").count() == bare
