"""Rows the rendered fixtures do not reach: malformed markup, order across categories, failures, duplicates."""
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from vigia.functions.text import collapse_ws, lead_words
from vigia.functions.urls import absolute_url
from vigia.operators import content as C
from vigia.operators import errors as E
from vigia.operators import history as H
from vigia.operators import notify as N
from vigia.operators import profiles as PR
from vigia.operators import report as R
from vigia.operators.select import Field, RecordSpec, extract_records, html_content, parse_selector
from vigia.operators.shred import parse_errors, shred, spread
from vigia.plans import job
from vigia.sources.alert_store import AlertStore
from vigia.sources.content_store import PlainContent
from vigia.sources import catalogue as CA
from vigia.sources import history as HS
from vigia.sources import rules as RU


def page(spark, html):
    return spark.createDataFrame([(1, html)], "page_id long, html string")


@pytest.mark.parametrize("html,want", [
    ("<h3>Dosis 5 < 10 mg</h3>", "Dosis 5 < 10 mg"),
    ("<h3>a &amp; b<!-- c --> d</h3>", "a & bd"),
    ("<h3>uno <b>dos</b> tres</h3>", "unodostres"),
])
def test_text_in_pieces_is_one_run(spark, html, want):
    r = extract_records(shred(page(spark, html)), "page_id", RecordSpec(None, {"t": Field("h3", "text_a")})).first()
    assert r.t == want


def test_unreadable_page_is_quarantined_whole(spark):
    df = spark.createDataFrame([(1, "<p>kept?</p><![x[ <p>lost</p>"), (2, "<p>fine</p>")], "page_id long, html string")
    rows = shred(df)
    errors = parse_errors(rows).collect()
    assert [r.page_id for r in errors] == [1] and errors[0].error
    assert {r.page_id for r in rows.where("kind = 'el'").collect()} == {2}
    listing = df.withColumn("source_id", F.lit("argentina")).withColumn("categoria", F.lit("x")).withColumn("categoria_rank", F.lit(1)).withColumn("status", F.lit(200))
    empty = spark.createDataFrame([], "source_id string, page_id long, categoria string, categoria_rank int, status int, xml string")
    details = spark.createDataFrame([], "url string, page_id long, status int, html string")
    _, bad = job.collect(listing, empty, details, 2024)
    assert [(r.source_id, r.page_id) for r in bad.collect()] == [("argentina", 1)]


def test_rows_of_one_batch_are_flushed(spark):
    html = "<div>" + "<p>x</p>" * 15_000 + "</div>"
    rows = shred(spark.createDataFrame([(i, html) for i in range(4)], "page_id long, html string").coalesce(1))
    assert rows.where("kind = 'el'").count() == 4 * 15_001
    assert rows.groupBy("page_id").agg(F.countDistinct("seq").alias("n")).where("n <> 30002").count() == 0


@pytest.mark.parametrize("link,want", [
    (" archivo/x.pdf", "https://a.org/d/archivo/x.pdf"), ("archivo/x.pdf\n", "https://a.org/d/archivo/x.pdf"),
    ("a\nb.pdf", "https://a.org/d/ab.pdf"), ("\x01\t/z.pdf", "https://a.org/z.pdf"), (" ", "https://a.org/d/p.html"),
])
def test_links_are_cleaned_like_the_standard_join(spark, link, want):
    from urllib.parse import urljoin
    got = spark.createDataFrame([("https://a.org/d/p.html", link)], "b string, l string").select(absolute_url("b", "l")).first()[0]
    assert got == want == urljoin("https://a.org/d/p.html", link)


@pytest.mark.parametrize("selector", ["#ads", "div > p", "a[href] b", "p:first-child"])
def test_unsupported_selectors_are_errors(spark, selector):
    with pytest.raises(ValueError):
        parse_selector(selector)
    rules = RU.rules_from_dict(spark, {"k": {"content_type": "html", "selectors": ["p"], "remove_selectors": [selector]}})
    assert [r.key for r in RU.rule_errors(rules).collect()] == ["k"]
    rows = shred(spark.createDataFrame([(1, "<p>kept</p><a name='x'>y</a>", "k")], "page_id long, html string, k string"), keep=["k"])
    assert html_content(RU.with_rules(rows, rules, "k"), "page_id").first().content == "kept"


def test_comma_groups_in_rules_and_attribute_tests(spark):
    rules = RU.rules_from_dict(spark, {"k": {"content_type": "html", "selectors": ["h1, p.x"]}, "a": {"content_type": "html", "selectors": ["a[name]"]},
                                       "c": {"content_type": "html", "container": "#main", "selectors": ["p"]}})
    assert {r.key for r in RU.rule_errors(rules).collect()} == {"a", "c"}
    html = "<h1>t</h1><p>no</p><p class=x>yes</p><a>never</a>"
    rows = shred(spark.createDataFrame([(1, html, "k"), (2, html, "a"), (3, html, "c")], "page_id long, html string, k string"), keep=["k"])
    got = {r.page_id: r.content for r in html_content(RU.with_rules(rows, rules, "k"), "page_id").collect()}
    assert got == {1: "t yes", 2: None, 3: None}


def _table(rows):
    return "<table>" + "".join(f"<tr><td>{a}</td><td>{b}</td><td>1/2/2024</td><td><a href='{u}'>v</a></td></tr>" for a, b, u in rows) + "</table>"


def test_last_category_wins_whatever_the_page_ids(spark):
    big = 9_000_000_000_000_000_000
    pages = spark.createDataFrame([(big, "uno", 1, _table([("1", "first", "x.pdf")])), (5, "dos", 2, _table([("2", "second", "x.pdf")]))],
                                  "page_id long, categoria string, categoria_rank int, html string")
    got = PR.rows_bolivia(shred(pages, keep=["categoria", "categoria_rank"]), 2024).collect()
    assert [(r.titulo, r.categoria, r.categoria_rank, r.page_id) for r in got] == [("2 - second", "dos", 1, big)]
    a = spark.createDataFrame([("u", "late", 1, 2, 3, 1), ("u", "early", 1, 1, 9, 5)], "url string, titulo string, source_rank int, categoria_rank int, page_id long, item_pos long")
    assert H.merge_history(a.limit(0), a).first().titulo == "early"


def test_first_cards_of_a_category_across_its_pages(spark):
    card = lambda i: f'<li class="clearfix documents"><div class="col-md-10">T{i}.pdf</div><div class="col-md-2"><a href="/{i}">d</a></div></li>'
    pages = spark.createDataFrame([(p, c, 1, "".join(card(100 * p + i) for i in range(15))) for p, c in ((1, "a"), (2, "a"), (3, "b"))],
                                  "page_id long, categoria string, categoria_rank int, html string")
    rows = shred(pages, keep=["categoria", "categoria_rank"])
    assert {r.categoria: r["count"] for r in PR.cards_mexico(rows, top_n=10).groupBy("categoria").count().collect()} == {"a": 10, "b": 10}
    assert PR.cards_mexico(rows).count() == 45


def test_error_policy_scopes_nulls_and_failed_pages(spark):
    df = spark.createDataFrame([("s", "a", None), ("s", "b", "bad"), (None, "c", None), (None, "d", "bad"), ("t", "e", None), ("f", "g", None)],
                               "scope string, url string, fatal string")
    failed = spark.createDataFrame([("f", "HTTP 500")], "scope string, fatal string")
    assert {r.url for r in E.drop_failed_groups(df, ["scope"], failures=failed).collect()} == {"e"}
    cards = '<a class="panel panel-default" href="/{0}"><h3>{0}</h3></a>'
    pages = spark.createDataFrame([("argentina", 1, "x", 1, 200, cards.format("ax")), ("argentina", 2, "y", 2, 500, ""), ("argentina", 3, "y", 2, 200, cards.format("ay")),
                                   ("mexico", 4, "x", 1, 500, ""), ("mexico", 5, "y", 2, 200, '<li class="clearfix documents"><div class="col-md-10">m.pdf</div><div class="col-md-2"><a href="/m">d</a></div></li>')],
                                  "source_id string, page_id long, categoria string, categoria_rank int, status int, html string")
    empty = spark.createDataFrame([], "source_id string, page_id long, categoria string, categoria_rank int, status int, xml string")
    details = spark.createDataFrame([], "url string, page_id long, status int, html string")
    good, bad = job.collect(pages, empty, details, 2024, parity=True)
    assert {r.titulo for r in good.collect()} == {"ax"}
    good, bad = job.collect(pages, empty, details, 2024)
    assert {r.titulo for r in good.collect()} == {"ax", "ay", "m"} and {r.fatal for r in bad.collect()} == {"HTTP 500"}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_parsed_once_in_a_whole_run(spark, monkeypatch, scratch):
    pages = spark.createDataFrame([], "source_id string, page_id long, categoria string, categoria_rank int, status int, html string")
    feeds = spark.createDataFrame([], "source_id string, page_id long, categoria string, categoria_rank int, status int, xml string")
    plans, real = [], job.stored
    monkeypatch.setattr(job, "stored", lambda df, name: (plans.append(_plan(df)), real(df, name))[1])
    good, bad = job.collect(pages, feeds, spark.createDataFrame([], "url string, page_id long, status int, html string"), 2024)
    assert sum(p.count("MapInArrow") for p in plans) == 2  # all listing pages, and Peru's detail pages
    store = AlertStore(spark, scratch)
    web, docs = spark.createDataFrame([], "url string, html string"), spark.createDataFrame([], "url string, page_no int, text string")
    job.run_on(store, good, PlainContent(web, docs), RU.rules_from_dict(spark, RU.COUNTRY_RULES))
    plans += [_plan(good), _plan(bad), _plan(store.outbox()), _plan(store.history())]
    assert sum(p.count("MapInArrow") for p in plans) == 3  # and the news' web pages


def test_fetched_twice_alerts_once(spark):
    news = spark.createDataFrame([("u", None, "t", "f", "Argentina", "i")], "url string, pdf string, titulo string, fecha string, pais string, institucion string")
    web = spark.createDataFrame([("u", "<div class='news__lead'><p>uno</p></div>"), ("u", "<div class='news__lead'><p>dos</p></div>")], "url string, html string")
    docs = spark.createDataFrame([], "url string, page_no int, text string")
    hist = spark.createDataFrame([], "url string, titulo string, resumen string, pais string")
    r = job.run(news, hist, web, docs, RU.rules_from_dict(spark, RU.COUNTRY_RULES))
    assert r.outbox.count() == 1 and r.news.first().resumen == "dos"


def test_history_is_written_only_with_news(spark, scratch):
    news = spark.createDataFrame([("u", "t", "f", "Chile", "i")], "url string, titulo string, fecha string, pais string, institucion string")
    hist = spark.createDataFrame([("u", "t", "", "Chile")], "url string, titulo string, resumen string, pais string")
    web, docs = spark.createDataFrame([], "url string, html string"), spark.createDataFrame([], "url string, page_no int, text string")
    rules = RU.rules_from_dict(spark, RU.COUNTRY_RULES)
    assert job.persist_history(job.run(news, hist, web, docs, rules), scratch) is None
    assert HS.current_version(spark, scratch) is None
    silent = job.run(news, hist.limit(0), web, docs, rules, silent=True)
    assert silent.outbox.count() == 0 and job.persist_history(silent, scratch)
    assert [r.url for r in HS.read_history(spark, scratch).collect()] == ["u"]


@contextmanager
def small_skew(spark):
    """Settings under which the adaptive planner sees skew in a small table."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _is_split(out):
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    return "skewed" in plan or "skew=true" in plan


def _hot(spark, n=60_000):
    wide = F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512))
    return spark.range(n).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"), wide.alias("titulo"))


def test_a_hot_link_is_split(spark):
    hist = spark.range(0, 60_000, 3).select(F.col("id").cast("string").alias("url"))
    with small_skew(spark):
        assert _is_split(H.novelty(_hot(spark).repartition(8), hist))


def test_a_hot_detail_link_is_split(spark):
    pages = spark.range(1, 60_000, 2).select(F.col("id").cast("string").alias("url"), F.col("id").alias("page_id"), F.lit("m").alias("motivo"), F.lit("p").alias("producto"), F.lit("f.pdf").alias("pdf"))
    pages = pages.union(spark.createDataFrame([("hot", 0, "m", "p", "h.pdf"), ("hot", -1, "m", "p", "h.pdf")], pages.schema))
    with small_skew(spark):
        details = job.stored(C.one_per_key(pages, "url"), "details")  # as feeds() joins them: written, one row a link
        assert _is_split(PR.feed_with_detail(_hot(spark).repartition(8), details))


def test_a_hot_link_of_the_store_is_split(spark, scratch):
    store = AlertStore(spark, scratch, buckets=4)
    store.add(spark.range(0, 60_000, 3).select(F.col("id").cast("string").alias("url"), F.lit("t").alias("titulo")))
    with small_skew(spark):
        assert _is_split(store.novelty(_hot(spark).repartition(8)))


def test_defaults_keep_everything(spark):
    h = spark.createDataFrame([("01-01-2001 10:00", "a"), ("Sin Fecha", "b")], "fecha string, pais string")
    assert R.prepare(h).count() == 2 and R.by_day(R.prepare(h)).count() == 2
    pages = spark.createDataFrame([("d", i, f"p{i}") for i in range(6)], "doc string, n int, t string")
    assert C.doc_first_pages(pages, "doc", "n", "t").first().content == "p0 p1 p2 p3 p4 p5"
    text = "\x1c".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(lead_words("t", 30)).first()[0].split(" ") == df.select(collapse_ws("t")).first()[0].split(" ")[:30]


def test_catalogue_pages_and_spread(spark, tmp_path):
    assert CA.catalogue(spark, 2024).count() == 21 and CA.catalogue(spark, 2024, pages=3).count() == 23
    spark.range(10).withColumn("html", F.lit("<p>x</p>")).coalesce(1).write.parquet(str(tmp_path / "one"))
    scan = spark.read.parquet(str(tmp_path / "one")).withColumnRenamed("id", "page_id")
    assert spread(scan) == spark.sparkContext.defaultParallelism
    assert "Exchange" not in shred(scan)._jdf.queryExecution().executedPlan().toString()


def test_message_without_pdf_column(spark):
    assert N.outbox(spark.createDataFrame([("u", "r", "f", "Chile", "i")], "url string, resumen string, fecha string, pais string, institucion string")).count() == 1
