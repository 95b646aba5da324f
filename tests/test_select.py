"""Shredding and selection against hand-worked goldens (malformed markup, nesting, modes)."""
from pyspark.sql import functions as F

from vigia.operators.select import Field, RecordSpec, extract_records, html_content
from vigia.operators.shred import shred
from vigia.sources import rules as RU


def records(spark, html, spec):
    rows = shred(spark.createDataFrame([(1, html)], "page_id long, html string"))
    return extract_records(rows, "page_id", spec).collect()


def test_text_modes(spark):
    r = records(spark, "<ul><li> A </li><li>B</li></ul>", RecordSpec(None, {
        "a": Field("ul", "text_a"), "b": Field("ul", "text_b"), "c": Field("ul", "text_c")}))[0]
    assert (r.a, r.b, r.c) == ("AB", "A B", "A B")


def test_absent_vs_empty(spark):
    r = records(spark, "<div><h3></h3></div>", RecordSpec(None, {"h3": Field("h3", "text_a"), "h4": Field("h4", "text_a")}))[0]
    assert r.h3 == "" and r.h3__found and r.h4 is None and not r.h4__found


def test_script_text_only_for_script_itself(spark):
    html = '<div><script>var t="</p>";</script><p>x</p></div>'
    r = records(spark, html, RecordSpec(None, {"d": Field("div", "text_c"), "s": Field("script", "text_b")}))[0]
    assert r.d == "x" and r.s == 'var t="</p>";'


def test_cards_first_match_and_parent(spark):
    html = ('<div class="row-fluid lista-noticias"><p class="data"><i class="icon-calendar"></i> 1/2/2025</p>'
            '<a href="/1">uno</a><a href="/2">dos</a></div>'
            '<div class="row-fluid lista-noticias other"><a href="/3">x</a></div>')
    spec = RecordSpec("div|row-fluid+lista-noticias", {"href": Field("a", "attr:href"),
                                                        "d": Field("p.data .icon-calendar", "text_b", parent=True)})
    rows = records(spark, html, spec)
    assert len(rows) == 1 and rows[0].href == "/1" and rows[0].d == "1/2/2025"


def test_descendant_chain_across_scope(spark):
    html = '<div class="bodyModel"><h4>t</h4><p>a<p>b</p></p></div><p>out</p>'
    rules = RU.rules_from_dict(spark, {"x": {"content_type": "html", "container": "div.bodyModel",
                                             "selectors": ["div h4", "div p"], "remove_selectors": ["script"]}})
    rows = shred(spark.createDataFrame([(1, html, "x")], "page_id long, html string, k string"), keep=["k"])
    out = html_content(RU.with_rules(rows, rules, "k"), "page_id").first()
    # nested p: the outer p holds both runs, the inner p repeats 'b'
    assert out.content == "t a b b"


def test_unclosed_tags_and_removal(spark):
    html = "<article><h1>T</h1><p><b>x<p>y</p></article><footer>f</footer>"
    rules = RU.rules_from_dict(spark, {"k": {"content_type": "html", "selectors": ["p"], "remove_selectors": ["footer"]}})
    rows = shred(spark.createDataFrame([(1, html, "k")], "page_id long, html string, k string"), keep=["k"])
    assert html_content(RU.with_rules(rows, rules, "k"), "page_id").first().content == "x y y"
    rules2 = RU.rules_from_dict(spark, {"k": {"content_type": "html", "container": "main", "selectors": ["p"]}})
    assert html_content(RU.with_rules(rows, rules2, "k"), "page_id").first().content is None


def test_shred_parse_tasks_survive_upstream_partitioning(spark):
    # pages assembled by a groupBy on the id are already hash-partitioned by it; the shredder's
    # fixed-count exchange must stay (AQE would otherwise coalesce the parse into few tasks)
    parts = spark.createDataFrame([(i // 4, f"<p>{i}</p>") for i in range(64)], "page_id long, part string")
    pages = parts.groupBy("page_id").agg(F.expr("listagg(part, '') within group (order by part)").alias("html"))
    rows = shred(pages, partitions=5)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "xxhash64(page_id" in plan
    got = rows.where(F.col("kind") == "text").groupBy("page_id").count().collect()
    assert len(got) == 16 and all(r["count"] == 4 for r in got)


def test_shred_rows_and_paths(spark):
    html = '<div class="a  b"><p>x<br>y</p><img src="i.png"/></div>tail'
    rows = shred(spark.createDataFrame([(7, html)], "page_id long, html string")).orderBy("seq").collect()
    assert [(r.kind, r.tag, r.text) for r in rows] == [
        ("doc", None, None), ("el", "div", None), ("el", "p", None), ("text", None, "x"), ("el", "br", None),
        ("text", None, "y"), ("el", "img", None), ("text", None, "tail")]
    assert [e.tag for e in rows[4].path] == ["div", "p", "br"] and rows[1].path[0].cls == "a b"
    assert rows[1].path[0].classes == ["a", "b"] and rows[6].attrs == {"src": "i.png"}
    assert [e.id for e in rows[5].path] == [0, 1] and rows[7].path == [] and rows[7].node_id is None
