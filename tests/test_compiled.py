"""Profile rows compiled to one plan give what the eight profiles' functions give; a source is added by data alone."""
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigia.operators import profiles as PR
from vigia.operators.compiled import OUT, ROWS, ProfileRow, compile_profiles
from vigia.plans import standins as S

SOURCES = [r.source_id for r in ROWS]


def table(df, *drop):
    cols = [c for c in OUT if c not in drop]
    return sorted(tuple(str(v) for v in r) for r in df.select(cols).collect())


def listing(spark):
    pages = None
    for n, s in enumerate(SOURCES):
        made = S.render_tables(spark, SF_SMALL, s) if s in ("bolivia", "costarica") else S.render_listing(spark, SF_SMALL, s)
        bad = spark.createDataFrame([(-1 - n, "x", 1, "<p>a</p><![x[")], made.schema)
        made = made.union(bad).withColumn("source_id", F.lit(s))
        pages = made if pages is None else pages.unionByName(made)
    return pages


def by_function(pages, s):
    fn = getattr(PR, ("rows_" if s in ("bolivia", "costarica") else "cards_") + s)
    mine = pages.where(F.col("source_id") == s).drop("source_id")
    return fn(mine, S.RUN_YEAR) if s in ("bolivia", "costarica") else fn(mine)


@pytest.fixture(scope="module")
def all_pages(spark):
    return listing(spark).cache()


@pytest.fixture(scope="module")
def compiled(all_pages):
    return compile_profiles(all_pages, ROWS, S.RUN_YEAR).cache()


@pytest.mark.parametrize("source", SOURCES)
def test_rows_give_what_the_functions_give(all_pages, compiled, source):
    want, got = by_function(all_pages, source), compiled.where(F.col("source_id") == source)
    assert table(got.where("page_id >= 0")) == table(want.where("page_id >= 0")) and got.count() > 10
    unread = [tuple(r) for df in (got, want) for r in df.where("page_id < 0").select("url", "page_id", "categoria", "source_id", "fatal").collect()]
    assert len(unread) == 2 and unread[0] == unread[1] and unread[0][4]


def test_one_plan_for_all(all_pages):
    plan = compile_profiles(all_pages, ROWS, S.RUN_YEAR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    more = [*ROWS, *(ProfileRow(f"s{i}", 20 + i, "X", "Y", "div.k", {"t": {"selector": "b"}}, title=("t",), link="attr:id") for i in range(20))]
    assert compile_profiles(all_pages, more, S.RUN_YEAR)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_a_ninth_source_by_data_alone(spark):
    uruguay = ProfileRow("uruguay", 9, "Uruguay", "MSP", "div.aviso", {
        "asunto": {"selector": "h2 span", "value": "text_c"}, "clase": {"selector": ".tag", "value": "text_b", "parent": True},
        "cuando": {"selector": "time", "value": "attr:data-d"}, "href": {"selector": 'a[href$=".html"]', "value": "attr:href"}},
        required=("asunto", "href"), title=("asunto", "clase"), title_sep=": ", title_default="(sin asunto)", date=("cuando",), date_formats=("yyyyMMdd", "d-M-yyyy"),
        date_missing="s/f", date_bad="fatal", link_rule="absolute", link_base="https://msp.example.uy/avisos/", year="not other", keep_last=True, top_n=5)
    card = '<div class="aviso"><h2><span>{0} <i>x</i></span></h2><p>tipo <b class=tag>!</b></p>{1}<a href="{2}">v</a></div>'
    html = "".join([card.format("Uno", "<time data-d=20240305>", "a.html"), card.format("Dos", "", "/b.html"), card.format("Tres", "<time data-d='7-8-2024'>", "a.html"),
                    card.format("Malo", "<time data-d=x>", "c.html"), card.format("Viejo", "<time data-d=20230305>", "d.html"), card.format("Sexto", "", "e.html"),
                    '<div class="aviso"><h2><span>sin enlace</span></h2></div>'])
    pages = spark.createDataFrame([("uruguay", 1, "c", 1, html), ("otro", 2, "c", 1, html)], "source_id string, page_id long, categoria string, categoria_rank int, html string")
    got = sorted(tuple(r) for r in compile_profiles(pages, [*ROWS, uruguay], 2024).select("url", "titulo", "fecha", "pais", "source_rank", "fatal").collect())
    base = "https://msp.example.uy"
    assert got == sorted([(f"{base}/avisos/a.html", "Tres x: tipo !", "07-08-2024", "Uruguay", 9, None), (f"{base}/b.html", "Dos x: tipo !", "s/f", "Uruguay", 9, None),
                          (f"{base}/avisos/c.html", "Malo x: tipo !", None, "Uruguay", 9, "bad date: x")])


@pytest.mark.parametrize("wrong", [{"title": ("nope",)}, {"link": "cell:1"}, {"title_rule": "?"}, {"year": "some"}])
def test_wrong_rows_are_refused(all_pages, wrong):
    row = {"source_id": "z", "source_rank": 1, "pais": "p", "institucion": "i", "container": "div", "fields": {"href": {"selector": "a", "value": "attr:href"}}} | wrong
    with pytest.raises(ValueError, match="profile z"):
        compile_profiles(all_pages, [ProfileRow(**row)], 2024)


def test_two_profiles_of_a_source_are_refused(all_pages):
    with pytest.raises(ValueError, match="two profiles"):
        compile_profiles(all_pages, [ROWS[0], ROWS[0]], 2024)
