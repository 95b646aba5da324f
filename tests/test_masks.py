"""Step masks against the path-based selectors: same records, same content, on given and random markup."""
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigia.operators import profiles as PR
from vigia.operators.masks import StepMasks, page_content, page_records
from vigia.operators.select import Field, RecordSpec, extract_records, html_content, parse_selector
from vigia.operators.shred import shred
from vigia.plans import standins as S
from vigia.sources import rules as RU

TAGS = ["div", "p", "a", "td", "tr", "table", "span", "script", "h3", "br", "pre", "ul"]
CLASSES = ["", "x", "y", "x y", "y  x", "card", "card x"]


def markup(rng):
    """Random, often unbalanced markup."""
    out = []
    for _ in range(rng.randrange(60)):
        tag, roll = rng.choice(TAGS), rng.random()
        if roll < 0.45:
            attrs = f' class="{rng.choice(CLASSES)}"' if rng.random() < 0.7 else ""
            attrs += rng.choice(["", "", ' href="f.pdf"', " href", ' src="g.pdf"'])
            out.append(f"<{tag}{attrs}>")
        elif roll < 0.75:
            out.append(f"</{tag}>")
        else:
            out.append(rng.choice([" ", "\n ", "uno", " dos  tres ", "&amp;", "a < b", "<!-- c -->", "ñ "]))
    return "".join(out)


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(7)
    rows = [(i, markup(rng)) for i in range(300)] + [(1000, None), (1001, ""), (1002, "solo texto"), (1003, "<p>kept?</p><![x[ <p>lost</p>"), (1004, "<p>" * 300 + "hondo")]
    return spark.createDataFrame(rows, "page_id long, html string").withColumn("k", F.concat(F.lit("k"), F.col("page_id") % 4)).cache()


def table(df):
    return sorted((tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect()))


SPECS = {
    "cards": RecordSpec("div.card, p|card+x", {"a": Field("a", "text_a"), "href": Field("div a", "attr:href"), "pdf": Field('[href$=".pdf"], [src$=".pdf"]', "attr:href"),
                                               "b": Field("span.x", "text_b"), "h": Field("div h3, p h3", "text_c"), "up": Field("div span.y", "text_b", parent=True),
                                               "any": Field("a", "text_c", parent=True)}),
    "rows": RecordSpec("tr", {"x": Field(".x", "text_b")}, cells_tag="td"),
    "nested": RecordSpec("div", {"d": Field("div div p", "text_a"), "s": Field("script", "text_b"), "pre": Field("pre", "text_b")}),
    "document": RecordSpec(None, {"t": Field("h3", "text_a"), "n": Field("ul a", "attr:href"), "u": Field("div a.x", "text_b", parent=True)}),
    "tests": RecordSpec("div", {"s": Field("a[href^=f]", "text_b"), "c": Field("a[href*=.p]", "attr:href"), "e": Field("[src=g.pdf]", "attr:src"), "has": Field("p[href]", "text_c")}),
}


@pytest.mark.parametrize("name", sorted(SPECS))
def test_records_equal_those_of_paths(pages, name):
    got = page_records(pages, "page_id", SPECS[name], keep=["k"])
    unread = got.where("page_error IS NOT NULL").collect()
    assert [r.page_id for r in unread] == [1003]
    want = extract_records(shred(pages, keep=["k"]), "page_id", SPECS[name], keep=["k"])
    got = table(got.where("page_error IS NULL").drop("page_error"))
    assert got == table(want) and len(got) > 20


RULES = {"k0": {"content_type": "html", "selectors": ["p", "div.x p", "td"], "remove_selectors": ["script", "div.y"], "container": "div.card"},
         "k1": {"content_type": "html", "selectors": ["span, a", "p p"], "remove_selectors": []},
         "k2": {"content_type": "html", "selectors": ["div"], "remove_selectors": ["p"], "container": "#main"},
         "k3": {"content_type": "html", "selectors": ["h3", "pre", "script", "h3"], "remove_selectors": ["table td"], "container": "div"}}


@pytest.mark.parametrize("title", [None, "h3", "div a"])
def test_content_equals_that_of_paths(spark, pages, title):
    rules = RU.rules_from_dict(spark, RULES)
    got = page_content(RU.with_rules(pages, rules, "k"), "page_id", keep=["k"], title_selector=title)
    want = html_content(RU.with_rules(shred(pages, keep=["k"]), rules, "k"), "page_id", keep=["k"], title_selector=title)
    assert table(got) == table(want) and got.where("content IS NOT NULL").count() > 30


def test_given_pages_under_their_rules(spark):
    p = S._page_lang(S.T(spark, SF_SMALL, "pages").select("page_id", "url", "html"))
    rules = RU.rules_bundled(spark, S.PAGE_RULES)
    got = page_content(RU.with_rules(p, rules, "lang"), "page_id", keep=["lang"], title_selector="title")
    assert table(got) == table(html_content(RU.with_rules(shred(p, keep=["lang"]), rules, "lang"), "page_id", keep=["lang"], title_selector="title"))
    assert table(page_records(p, "page_id", S.HTML_SELECT).drop("page_error")) == table(extract_records(shred(p), "page_id", S.HTML_SELECT))


@pytest.mark.parametrize("source", ["brasil", "colombia", "mexico", "argentina", "bolivia", "costarica"])
def test_profiles_on_pages_and_on_rows(spark, source):
    profile = getattr(PR, ("rows_" if source in ("bolivia", "costarica") else "cards_") + source)
    made = S.render_tables(spark, SF_SMALL, source) if source in ("bolivia", "costarica") else S.render_listing(spark, SF_SMALL, source)
    how = (S.RUN_YEAR,) if source in ("bolivia", "costarica") else ()
    assert table(profile(made, *how)) == table(profile(shred(made, keep=["categoria", "categoria_rank"]), *how))


def test_unread_pages_keep_their_reason_through_a_profile(spark):
    bad = spark.createDataFrame([(1, "c", 1, "<tr><td>1</td></tr><![x["), (2, "c", 1, "<p>ok</p>"), (3, "c", 1, "<![y[")], "page_id long, categoria string, categoria_rank int, html string")
    for profile in (PR.cards_brasil, PR.cards_colombia, PR.cards_argentina, lambda p: PR.cards_mexico(p, top_n=1), lambda p: PR.rows_bolivia(p, 2024), lambda p: PR.rows_costarica(p, 2024)):
        got = profile(bad).collect()
        assert sorted((r.page_id, r.url) for r in got) == [(1, None), (3, None)] and all(r.fatal for r in got)


def test_masks_are_subsequences_of_the_path():
    masks = StepMasks([list(c.steps) for c in parse_selector("div p, div div, p, div.x p a")])
    above, seen = 0, []
    for tag, cls in [("div", "x"), ("ul", ""), ("p", ""), ("div", ""), ("a", "")]:
        new = masks.enter(above, tag, cls)
        seen.append([bool(new & e) for e in masks.ends])
        above |= new
    assert seen == [[False] * 4, [False] * 4, [True, False, True, False], [False, True, False, False], [False, False, False, True]]


def test_no_path_leaves_the_parser(spark, pages):
    got = page_content(RU.with_rules(pages, RU.rules_from_dict(spark, RULES), "k"), "page_id", keep=["k"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "path" not in plan.split("MapInArrow")[0]


def test_plain_markup_reads_as_the_event_parser_reads_it():
    """Pages of plain markup are read tag by tag; anything else goes to the event parser."""
    import random

    from vigia.operators.tree import TreeParser, plain_tokens

    class Calls(TreeParser):
        def __init__(self):
            super().__init__()
            self.calls = []

        def element(self, *a):
            self.calls.append(("element", self.seq, *a))

        def text(self, *a):
            self.calls.append(("text", self.seq, *a))

        def cut(self, depth):
            self.calls.append(("cut", self.seq, depth))

    def calls(html, way):
        parser = Calls()
        try:
            way(parser, html)
        except Exception as e:
            return type(e)
        return parser.calls

    def by_events(parser, html):
        parser.feed(html)
        parser.close()
        parser.end_text()

    plain = ["<div>", "</div>", '<p class="a b">', "</p>", "<br>", "<Div Class='X'>", "</DIV>", "text", " ", "\n", "&amp;", "&lt", "& ", "&#0;",
             '<a href="/x?a=1&copy=2">', "</a>", '<a\nhref="x"\tb="" >', '<a b="1" b="2">', "<td>", "</td>", ">"]
    other = [*plain, "<!-- c -->", "<!DOCTYPE html>", "<script>", "</script>", "<pre>", "</pre>", "<title>", "</title>", "<template>", "< ", "<", "\"", "<a b=c>",
             "<a b>", '<img src="u"/>', "<x-y>", "</div x>", "<![x[", "\x00", '<a b="1"c="2">']
    rnd, read_plain = random.Random(5), 0
    for i in range(6000):
        html = "".join(rnd.choice(other if i % 2 else plain) for _ in range(rnd.randint(1, 12)))
        read_plain += plain_tokens(html) is not None
        assert calls(html, Calls.read) == calls(html, by_events), html
    assert read_plain > 3000
    assert plain_tokens("<p>a</p><script>x</script>") is None and plain_tokens("a < b") is None
