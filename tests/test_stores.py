"""One commit for history and outbox, append-only batches, newest fetch, no exchange of what lies in buckets."""
import os
import re

import pytest
from pyspark.sql import functions as F

from vigia.operators import content as C
from vigia.plans import job
from vigia.sources import rules as RU
from vigia.sources.alert_store import AlertStore
from vigia.sources.buckets import BucketedLog
from vigia.sources.content_store import ContentStore, PlainContent

ALERT = "url string, titulo string, fecha string, pais string, institucion string, source_rank int, item_pos long"


def alerts(spark, *urls):
    return spark.createDataFrame([(u, f"t{i}", "f", "Chile", "i", 1, i) for i, u in enumerate(urls)], ALERT)


def run(store, candidates, **how):
    spark = candidates.sparkSession
    web, docs = spark.createDataFrame([], "url string, html string"), spark.createDataFrame([], "url string, page_no int, text string")
    return job.run_on(store, candidates, PlainContent(web, docs), RU.rules_from_dict(spark, RU.COUNTRY_RULES), **how)


def sent(store):
    return sorted(r.url for r in store.outbox().collect())


def links(store):
    return sorted(r.url for r in store.history().collect())


def scan_ancestors(df, marker="Bucketed: true"):
    """Operators above each scan that holds ``marker`` in the physical plan."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda s: len(re.match(r"[ :+\-]*", s)[0])
    out = []
    for i, line in enumerate(lines):
        if marker in line:
            at, above = depth(line), []
            for j in range(i - 1, -1, -1):
                if depth(lines[j]) < at:
                    at = depth(lines[j])
                    above.append(lines[j].strip(" :+-"))
            out.append(above)
    return out


def below_join(above):
    """The scan meets the join without an exchange."""
    joins = [i for i, a in enumerate(above) if "LeftSemi" in a]
    return bool(joins) and not any("Exchange" in a for a in above[:joins[0]])


def test_runs_append_only_their_news(spark, scratch):
    store = AlertStore(spark, scratch, buckets=3)
    assert links(store) == [] and sent(store) == []
    one = run(store, alerts(spark, "a", "b", "a"))
    assert links(store) == ["a", "b"] and sent(store) == ["a", "a", "b"]  # in-batch duplicates are each notified
    assert run(store, alerts(spark, "b", "a")) is None and store.state().seq == 1
    two = run(AlertStore(spark, scratch), alerts(spark, "b", "c"))
    assert links(store) == ["a", "b", "c"] and sent(store) == ["a", "a", "b", "c"]
    assert {r.url for r in store.log.read([two]).collect()} == {"c"} and {r.url for r in store.log.read([one]).collect()} == {"a", "b"}
    assert {r.titulo for r in store.history().where("url = 'a'").collect()} == {"t0"}  # first of the batch
    counters = [r.counters for r in store.commits().collect()]
    assert counters[1] == {"history_rows": 2, "candidate_rows": 2, "novelty_rows": 1, "content_chars": 0, "stored_rows": 1}


def test_silent_runs_store_and_send_nothing(spark, scratch):
    store = AlertStore(spark, scratch)
    run(store, alerts(spark, "a"), silent=True)
    assert links(store) == ["a"] and sent(store) == []


@pytest.mark.parametrize("dies_at", ["before the messages", "before the commit", "in the commit"])
def test_a_killed_run_loses_and_repeats_no_message(spark, scratch, monkeypatch, dies_at):
    store = AlertStore(spark, scratch, buckets=3)
    run(store, alerts(spark, "a"))

    class Killed(Exception):
        pass

    def die(*_):
        raise Killed

    with monkeypatch.context() as m:
        if dies_at == "before the messages":
            m.setattr(store.log, "read", lambda batches=None, real=store.log.read: die() if batches and batches[0] > 1 << 33 else real(batches))
        elif dies_at == "before the commit":
            m.setattr(store, "_commit", die)
        else:  # the commit's files are there, but not finished
            m.setattr(store, "_commit", lambda *_: (os.makedirs(f"{scratch}/_commits/_temporary/0"), die()))
        with pytest.raises(Killed):
            run(store, alerts(spark, "a", "b", "c"))
    again = AlertStore(spark, scratch)
    assert links(again) == ["a"] and sent(again) == ["a"]  # nothing of the dead run is seen
    run(again, alerts(spark, "a", "b", "c"))
    assert links(again) == ["a", "b", "c"] and sent(again) == ["a", "b", "c"]


def test_two_runs_under_one_number_are_noticed(spark, scratch):
    store = AlertStore(spark, scratch)
    run(store, alerts(spark, "a"))
    with pytest.raises(RuntimeError, match="two runs"):
        store._commit(1, [], [], [], {})


def test_an_older_history_file_is_imported_once(spark, scratch):
    rows = spark.createDataFrame([("a", "uno\ndos", "f", "i"), ("b", 'con "comillas"', "f", "i"), (None, "sin url", "f", "i"), ("a", "zz", "f", "i")], "url string, titulo string, fecha string, institucion string")
    rows.write.option("header", True).option("escape", '"').csv(f"{scratch}/old")
    store = AlertStore(spark, f"{scratch}/store", buckets=2)
    assert store.import_csv(f"{scratch}/nope") is None and store.import_csv(f"{scratch}/old")
    got = {r.url: (r.titulo, r.pais, r.resumen) for r in store.history().collect()}
    assert got == {"a": ("uno\ndos", "Desconocido", ""), "b": ('con "comillas"', "Desconocido", "")}
    assert store.import_csv(f"{scratch}/old") is None  # nothing new the second time
    run(store, alerts(spark, "a", "c"))
    assert links(store) == ["a", "b", "c"] and sent(store) == ["c"]


def test_compaction_keeps_links_and_moves_nothing(spark, scratch):
    store = AlertStore(spark, scratch, buckets=4)
    for k in range(4):
        run(store, alerts(spark, f"u{k}", f"v{k}"))
    merged = store.compact(keep=1)
    state = store.state()
    assert len(state.history) == 2 and merged in state.history
    assert links(store) == sorted(f"{c}{k}" for c in "uv" for k in range(4)) and len(sent(store)) == 8
    assert run(store, alerts(spark, "u0", "v3")) is None
    assert store.log.read([merged]).count() == 6 and store.compact(keep=1) is None
    assert store.compact(keep=0) is not None and store.compact(keep=0) is None and len(store.state().history) == 1
    assert links(store) == sorted(f"{c}{k}" for c in "uv" for k in range(4))


def test_history_is_not_exchanged(spark, scratch):
    store = AlertStore(spark, scratch, buckets=4)
    for k in range(3):
        run(store, alerts(spark, *[f"{k}-{i}" for i in range(20)]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = store.fresh_links(alerts(spark, "0-1", "x"))
        assert [r.url for r in fresh.collect()] == ["x"]
        scans = scan_ancestors(fresh)  # in the first and in the final plan
        assert scans and all(below_join(above) for above in scans)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def fetches(spark, rows, what):
    return spark.createDataFrame(rows, f"url string, {what}, at string").withColumn("fetched_at", F.col("at").cast("timestamp")).drop("at")


def test_the_newest_fetch_counts(spark, scratch):
    store = ContentStore(spark, scratch, buckets=2)
    page = "<div class='news__lead'><p>{}</p></div>"
    store.add(2, fetches(spark, [("w", page.format("nuevo"), "2024-02-01"), ("w", page.format("medio"), "2024-01-15"), ("z", page.format("otro"), "2024-02-01")], "html string"),
              fetches(spark, [("d", 0, "texto nuevo", "2024-02-01"), ("d", 1, "fin", "2023-01-01")], "page_no int, text string"))
    store.add(1, fetches(spark, [("w", page.format("viejo"), "2024-01-01"), ("w", page.format("sin fecha"), None), (None, "x", None)], "html string"),
              fetches(spark, [("d", 0, "texto viejo", "2024-01-01"), ("d", 1, "fin viejo", "2022-01-01"), ("q", 0, "no pedido", "2024-01-01")], "page_no int, text string"))
    assert store.web.read().where("url = 'w'").count() == 2  # one row a batch
    routed = spark.createDataFrame([("w", "Argentina", "html"), ("d", "Chile", "pdf"), ("nope", "Chile", "pdf"), (None, "Chile", None)], "content_key string, pais string, content_type string")
    rules = RU.rules_from_dict(spark, RU.COUNTRY_RULES)
    got = {r.content_key: r.content for r in job.content_table(routed, store, rules).collect()}
    assert got == {"w": "nuevo", "d": "texto nuevo fin"}
    store.add(2, fetches(spark, [("w", page.format("corregido"), "2024-03-01")], "html string"))  # the same batch again replaces it
    assert store.web_pages().where("url = 'z'").count() == 0
    got = {r.content_key: r.content for r in job.content_table(routed, store, rules).collect()}
    assert got["w"] == "corregido"


def test_markup_is_not_exchanged_before_it_is_wanted(spark, scratch):
    store = ContentStore(spark, scratch, buckets=4)
    store.add(1, fetches(spark, [(f"u{i}", f"<p>{i}</p>", "2024-01-01") for i in range(50)], "html string"))
    store.add(2, fetches(spark, [(f"u{i}", f"<p>{i} b</p>", "2024-02-01") for i in range(0, 50, 2)], "html string"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        want = spark.createDataFrame([("u3",), ("u4",), ("u4",)], "url string").distinct()
        newest = C.newest_fetch(store.web_pages(want), ["url"])
        assert {r.url: r.html for r in newest.collect()} == {"u3": "<p>3</p>", "u4": "<p>4 b</p>"}
        scans = scan_ancestors(newest)
        assert scans and all(below_join(above) and not any("Exchange" in a for a in above) for above in scans)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_stay_as_first_written(spark, scratch):
    log = BucketedLog(spark, scratch, spark.createDataFrame([], "url string, n int").schema, buckets=3)
    assert log.buckets is None and log.read().count() == 0
    log.append(spark.createDataFrame([("a", 1), ("b", 2)], "url string, n int"), 5)
    other = BucketedLog(spark, scratch, log.schema, buckets=7)
    other.append(spark.createDataFrame([("c", 3)], "url string, n int"), 6)
    assert other.buckets == 3 and sorted(tuple(r) for r in log.read().collect()) == [("a", 1, 5), ("b", 2, 5), ("c", 3, 6)]
    assert [r.url for r in log.read([6]).collect()] == ["c"] and log.read([]).count() == 0
