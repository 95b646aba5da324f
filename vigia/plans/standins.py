"""Query builders over the shared test tables.

Where no natural input exists (feeds, cards, table rows, detail pages) the query *renders* the
markup from table columns, then runs the real operator on it; the SQL oracle computes the
expected result straight from the same columns, so an extraction error shows as a difference.
Every builder reads whole tables; rendering groups are bounded (a listing page holds at most
``PAGE_CARDS`` orders, a feed at most ``FEED_ITEMS`` events, a table page one customer's orders).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as TX
from ..functions.urls import absolute_url, host_of
from ..operators import content as C
from ..operators import errors as E
from ..operators import history as H
from ..operators import notify as N
from ..operators import profiles as PR
from ..operators import report as R
from ..operators.masks import page_content, page_records
from ..operators.select import Field, RecordSpec
from ..operators.shred import dealt, shred, spread
from ..operators.summary import extractive_summaries
from ..session import checkpoint_dir, pin_session
from ..sources import feeds as FD
from ..sources import history as HS
from ..sources import rules as RU

PAGE_CARDS = 40          # orders per rendered listing page
TABLE_ROWS = 32          # orders per rendered table page
FEED_ITEMS = 64          # events per rendered feed document
RUN_YEAR = 1998          # year filter for the table sources (orders span 1995-2001)
CATALOGUE_YEAR = 2024
MIN_DATE = dt.date(2024, 1, 10)
DAY_CUTOFF = dt.date(2024, 1, 15)
SELECTION = ["click", "view"]
COUNTRIES = ["Perú", "Chile", "Brasil", "Colombia", "México", "Argentina", "Bolivia", "Costa Rica"]
# Spanish month names as written in Costa Rica titles.
MONTHS_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "setiembre",
             "octubre", "noviembre", "diciembre"]
PAGE_RULES = os.path.join(os.path.dirname(__file__), "..", "config", "page_rules.json")
URL_FORMS = ["b.pdf", "../x.pdf", "//cdn.example.org/x.pdf", "?q=1", "#f", "./y.pdf",
             "a/../b.pdf?x=/../1", "../../../z", "", "http://o.example/x", None]


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    pin_session(spark)
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def _k(c="o_orderkey"):
    return F.col(c)


def _esc(c):
    return TX.html_escape(c)


# ------------------------------------------------------------------------ string scalars

def _pad(i):
    pads = F.array(F.lit("  "), F.lit("\t\n"), F.lit(" \u00a0\u3000"))
    return F.element_at(pads, (i % 3 + 1).cast("int"))


def q_strip_ws(spark, sf):
    d = T(spark, sf, "documents")
    s = F.concat(_pad(F.col("doc_id")), F.col("text"), _pad(F.col("doc_id") + 1))
    return d.select("doc_id", TX.strip_ws(s).alias("value"))


def q_collapse_ws(spark, sf):
    d = T(spark, sf, "documents")
    return d.select("doc_id", TX.collapse_ws("text").alias("value"))


def q_html_escape(spark, sf):
    return T(spark, sf, "pages").select("page_id", TX.html_escape("html").alias("value"))


def q_preview(spark, sf):
    return T(spark, sf, "documents").select("doc_id", TX.preview("text", 50).alias("value"))


def _mexico_title_raw(d):
    k = F.col("doc_id")
    d8 = F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), (k % 700).cast("int")), "ddMMyyyy")
    d8 = F.when(k % 13 == 0, F.concat(F.lit("32"), F.substring(d8, 3, 6))).otherwise(d8)
    return F.when(k % 7 == 0, F.concat(F.col("text"), F.lit(".pdf"))).otherwise(
        F.concat(F.lit("_ "), F.col("text"), F.lit(" _"), d8, F.lit(".pdf "), F.col("source")))


def q_title_mexico(spark, sf):
    d = T(spark, sf, "documents")
    raw = _mexico_title_raw(d)
    return d.select("doc_id", TX.clean_title_mexico(raw).alias("titulo"))


def _cr_prefix(k):
    m = F.element_at(F.array(*[F.lit(x) for x in MONTHS_ES]), (k % 12 + 1).cast("int"))
    day = (k % 28 + 1).cast("string")
    v = k % 5
    return (F.when(v == 0, F.concat(day, F.lit(" de "), m, F.lit(" de 2025. ")))
            .when(v == 1, F.concat(day, F.lit(" DE "), F.upper(m), F.lit(" de 2024- ")))
            .when(v == 2, F.concat(day, F.lit(" de "), m, F.lit(" ")))
            .when(v == 3, F.concat(day, F.lit(" de "), m, F.lit(". ")))
            .otherwise(F.lit("")))


def q_title_costarica(spark, sf):
    d = T(spark, sf, "documents")
    raw = F.concat(_cr_prefix(F.col("doc_id")), F.col("text"))
    return d.select("doc_id", TX.clean_title_costarica(raw).alias("titulo"))


def q_url_absolute(spark, sf):
    pages = T(spark, sf, "pages")
    rows = shred(pages.select("page_id", "url", "html"), keep=["url"])
    nav = (rows.where((F.col("kind") == "el") & (F.col("tag") == "a"))
           .select("page_id", "url", F.try_element_at("attrs", F.lit("href")).alias("link")))
    forms = pages.select("page_id", "url", F.posexplode(F.array(*[F.lit(f).cast("string") for f in URL_FORMS])).alias("i", "link"))
    forms = forms.select("page_id", "url", "link")
    return nav.unionByName(forms).select("page_id", "link", absolute_url(F.col("url"), F.col("link")).alias("resolved"))


def q_flag_lookup(spark, sf):
    cu = T(spark, sf, "customer").select("c_custkey", "c_nationkey")
    na = T(spark, sf, "nation").select("n_nationkey", "n_name")
    j = cu.join(na, cu.c_nationkey == na.n_nationkey, "left")
    names = F.array(*[F.lit(c) for c in COUNTRIES])
    pais = F.when(F.col("n_nationkey") % 10 < 8, F.element_at(names, (F.col("n_nationkey") % 10 + 1).cast("int"))).otherwise(F.col("n_name"))
    return j.select("c_custkey", pais.alias("pais"), N.flag(pais).alias("bandera"))


# ------------------------------------------------------------------------ dates on rendered strings

def _ts_of_order(o):
    k = F.col("o_orderkey")
    return (F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"), (k % 60).cast("int")))


def q_date_brasil(spark, sf):
    o = T(spark, sf, "orders")
    k = _k()
    ts = _ts_of_order(o)
    d = F.when(k % 13 == 0, F.concat(F.lit("31/02/"), F.year(ts).cast("string"))).otherwise(F.date_format(ts, "d/M/yyyy"))
    raw = F.concat(d, F.when(k % 5 == 0, F.lit("  ")).otherwise(F.lit(" ")), F.date_format(ts, "H:mm"))
    _, fecha, _ = D.apply_policy(raw, D.POLICIES["brasil"], raw_fallback=d)
    return o.select("o_orderkey", fecha.alias("fecha"))


def q_date_colombia(spark, sf):
    o = T(spark, sf, "orders")
    k = _k()
    raw = F.when(k % 13 == 0, F.concat(F.year("o_orderdate").cast("string"), F.lit("-13-45"))).otherwise(F.date_format("o_orderdate", "yyyy-M-d"))
    _, fecha, status = D.apply_policy(raw, D.POLICIES["colombia"])
    return o.select("o_orderkey", fecha.alias("fecha"), F.when(status != "ok", F.lit("bad date")).alias("error"))


def _mexico_order_title(k, ts):
    d8 = F.when(k % 13 == 0, F.concat(F.lit("32"), F.date_format(ts, "MMyyyy"))).otherwise(F.date_format(ts, "ddMMyyyy"))
    return F.when(k % 7 == 0, F.concat(F.lit("Alerta "), k.cast("string"), F.lit(".pdf"))).otherwise(
        F.concat(F.lit("Alerta "), k.cast("string"), F.lit(" _"), d8, F.lit(".pdf")))


def q_date_mexico(spark, sf):
    o = T(spark, sf, "orders")
    t = _mexico_order_title(_k(), F.col("o_orderdate"))
    _, fecha, _ = D.apply_policy(TX.first_8_digits(t), D.POLICIES["mexico"])
    return o.select("o_orderkey", fecha.alias("fecha"))


def _iso_raw(k, ts):
    return (F.when(k % 17 == 0, F.lit(None).cast("string"))
            .when(k % 13 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))


def q_date_argentina(spark, sf):
    o = T(spark, sf, "orders")
    _, fecha, _ = D.apply_policy(_iso_raw(_k(), _ts_of_order(o)), D.POLICIES["argentina"])
    return o.select("o_orderkey", fecha.alias("fecha"))


def q_date_costarica(spark, sf):
    o = T(spark, sf, "orders")
    _, fecha, _ = D.apply_policy(_iso_raw(_k(), _ts_of_order(o)), D.POLICIES["costarica"])
    return o.select("o_orderkey", fecha.alias("fecha"))


def _bolivia_raw(k):
    return F.when(k % 13 == 0, F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string"))).otherwise(F.date_format("o_orderdate", "d/M/yyyy"))


def q_date_bolivia(spark, sf):
    o = T(spark, sf, "orders")
    ts, fecha, status = D.apply_policy(_bolivia_raw(_k()), D.POLICIES["bolivia"])
    return o.select("o_orderkey", fecha.alias("fecha"), status.alias("_s")).where("_s = 'ok'").drop("_s")


def q_year_filter_bolivia(spark, sf):
    o = T(spark, sf, "orders")
    ts, fecha, status = D.apply_policy(_bolivia_raw(_k()), D.POLICIES["bolivia"])
    return (o.select("o_orderkey", ts.alias("ts"), fecha.alias("fecha"))
            .where(D.current_year_filter("ts", RUN_YEAR, strict=True)).drop("ts"))


def q_year_filter_costarica(spark, sf):
    o = T(spark, sf, "orders")
    ts, fecha, _ = D.apply_policy(_iso_raw(_k(), _ts_of_order(o)), D.POLICIES["costarica"])
    return (o.select("o_orderkey", ts.alias("ts"), fecha.alias("fecha"))
            .where(D.current_year_filter("ts", RUN_YEAR, strict=False)).drop("ts"))


# ------------------------------------------------------------------------ feeds

def _rfc822(ts, k):
    v = k % 4
    shifted = (F.when(v == 1, ts - F.expr("INTERVAL 5 HOURS"))
               .when(v == 3, ts + F.expr("INTERVAL 90 MINUTES")).otherwise(ts))
    zone = F.when(v == 0, F.lit(" +0000")).when(v == 1, F.lit(" -0500")).when(v == 2, F.lit(" GMT")).otherwise(F.lit(" +0130"))
    return F.concat(F.date_format(shifted, "EEE, dd MMM yyyy HH:mm:ss"), zone)


def render_feeds(spark, sf) -> DataFrame:
    e = T(spark, sf, "events")
    k = F.col("event_id")
    pub = (F.when(k % 7 == 0, F.lit(""))
           .when(k % 11 == 0, F.lit("<pubDate>not a date</pubDate>"))
           .otherwise(F.concat(F.lit("<pubDate>"), _rfc822(F.col("ts"), k), F.lit("</pubDate>"))))
    item = F.concat(F.lit("<item><title>"), _esc(F.concat_ws(" ", "event_type", k.cast("string"))), F.lit("</title><link>"),
                    F.lit("https://feeds.example.org/e/"), k.cast("string"), F.lit("</link>"), pub, F.lit("</item>"))
    items = e.select((k / FEED_ITEMS).cast("bigint").alias("feed_id"), k.alias("event_id"), item.alias("item"))
    docs = items.groupBy("feed_id").agg(F.expr("listagg(item, '') within group (order by event_id)").alias("items"))
    return docs.select("feed_id", F.concat(F.lit('<rss version="2.0"><channel><title>alertas</title>'), F.col("items"),
                                           F.lit("</channel></rss>")).alias("xml"))


def q_feed_items(spark, sf):
    it = FD.with_feed_date(FD.feed_items(render_feeds(spark, sf), keep=["feed_id"]), "peru")
    return it.select("feed_id", F.col("item_pos").cast("bigint").alias("item_pos"), "titulo", "url", "fecha")


def q_date_feed(spark, sf):
    it = FD.with_feed_date(FD.feed_items(render_feeds(spark, sf), keep=["feed_id"]), "chile")
    return it.select("url", "fecha")


# ------------------------------------------------------------------------ listing pages

def _title(k):
    return F.concat(F.lit("Alerta "), k.cast("string"), F.lit(" &amp; retiro"))


def _card_brasil(k, ts):
    a = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit('<a href="/alertas/'), k.cast("string"), F.lit('">  '), _title(k), F.lit(" </a>")))
    d = F.when(k % 13 == 0, F.concat(F.lit("31/02/"), F.year(ts).cast("string"))).otherwise(F.date_format(ts, "d/M/yyyy"))
    return F.concat(
        F.lit('<div class="row-fluid lista-noticias"><div class="span9 titulo-resumo"><p class="titulo">'), a,
        F.lit('</p><p class="resumo">resumo</p></div><div class="span3 data-hora"><p class="data"><i class="icon-calendar"></i> '),
        d, F.lit('</p><p class="hora"><i class="icon-time"></i> '), F.date_format(ts, "H:mm"), F.lit("</p></div></div>\n"))


def _card_colombia(k, ts):
    t = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(
        F.lit('<div class="views-field views-field-title"><span class="field-content">'), _title(k), F.lit("</span></div>")))
    d = F.when(k % 13 == 0, F.concat(F.year(ts).cast("string"), F.lit("-13-45"))).otherwise(F.date_format(ts, "yyyy-M-d"))
    return F.concat(F.lit('<div class="views-row alertas-invima-list">'), t,
                    F.lit('<div class="views-field views-field-field-a-o"><div class="field-content">'), d,
                    F.lit('</div></div><span class="views-field views-field-field-comunicado-invima"><a href="/files/'),
                    k.cast("string"), F.lit('.pdf">Ver</a></span></div>'))


def _card_mexico(k, ts):
    a = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit('<a href="/cofepris/documentos/'), k.cast("string"), F.lit('.pdf">Descargar</a>')))
    return F.concat(F.lit('<li class="clearfix documents"><div class="col-md-10">'), _mexico_order_title(k, ts),
                    F.lit('</div><div class="col-md-2">'), a, F.lit("</div></li>"))


def _card_argentina(k, ts):
    h3 = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("<h3> Alerta "), k.cast("string"), F.lit(" <b>&amp;</b> retiro </h3>")))
    raw = _iso_raw(k, ts)
    tm = F.when(raw.isNull(), F.lit("")).otherwise(F.concat(F.lit('<time datetime="'), raw, F.lit('">fecha</time>')))
    return F.concat(F.lit('<a class="panel panel-default" href="/anmat/alertas/'), k.cast("string"),
                    F.lit('"><div class="panel-body">'), h3, tm, F.lit("</div></a>"))


CARD_RENDER = {"brasil": _card_brasil, "colombia": _card_colombia, "mexico": _card_mexico, "argentina": _card_argentina}


def render_listing(spark, sf, source: str) -> DataFrame:
    """Listing pages: one per (category = order priority, block of PAGE_CARDS order keys)."""
    o = T(spark, sf, "orders")
    k = _k()
    cards = o.select(
        F.col("o_orderpriority").alias("categoria"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("categoria_rank"),
        (k / PAGE_CARDS).cast("bigint").alias("block"), k.alias("k"),
        CARD_RENDER[source](k, _ts_of_order(o)).alias("card"))
    pages = cards.groupBy("categoria", "categoria_rank", "block").agg(
        F.expr("listagg(card, '') within group (order by k)").alias("cards"))
    wrap = "ul" if source == "mexico" else "div"
    return pages.select(
        (F.col("block") * 10 + F.col("categoria_rank")).alias("page_id"), "categoria", "categoria_rank",
        F.concat(F.lit(f'<html><body><h1>Alertas</h1><{wrap} class="lista">'), F.col("cards"), F.lit(f"</{wrap}></body></html>")).alias("html"))


def _dealt(spark) -> int:
    # rendered pages come from a groupBy whose few bytes AQE would coalesce into one parse task
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _listing_pages(spark, sf, source):
    return dealt(render_listing(spark, sf, source), "page_id", _dealt(spark))


def _alert_cols(df):
    return df.select("categoria", "url", "titulo", "fecha", "pais", "institucion")


def q_cards_brasil(spark, sf):
    return _alert_cols(E.apply_error_policy(PR.cards_brasil(_listing_pages(spark, sf, "brasil")), ["source_id"], parity=False))


def q_cards_colombia(spark, sf):
    return _alert_cols(E.apply_error_policy(PR.cards_colombia(_listing_pages(spark, sf, "colombia")), ["source_id"], parity=False))


def q_cards_mexico(spark, sf):
    return _alert_cols(PR.cards_mexico(_listing_pages(spark, sf, "mexico")))


def q_topn_per_category(spark, sf):
    m = PR.cards_mexico(_listing_pages(spark, sf, "mexico"), top_n=10)
    return m.groupBy("categoria").agg(F.count(F.lit(1)).alias("n_alertas"))


def q_cards_argentina(spark, sf):
    return _alert_cols(PR.cards_argentina(_listing_pages(spark, sf, "argentina")))


def _row_bolivia(k, status):
    a = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit('<a href="archivo/'), (k / 3).cast("bigint").cast("string"), F.lit('.pdf">Ver</a>')))
    return F.concat(F.lit("<tr><td> "), k.cast("string"), F.lit(" </td><td>Alerta &amp; "), status, F.lit("</td><td>"),
                    _bolivia_raw(k), F.lit("</td><td>"), a, F.lit("</td></tr>"))


def _row_costarica(k, ts):
    title = F.concat(_cr_prefix(k), F.lit("ALERTA "), k.cast("string"), F.lit(" RETIRO &amp; aviso"))
    dt_attr = F.when(k % 19 == 0, F.lit("")).otherwise(F.concat(F.lit(' data-title="'), title, F.lit('"')))
    a = F.when(k % 11 == 0, F.lit("<span>sin archivo</span>")).otherwise(F.concat(
        F.lit('<a class="docman_track_download"'), dt_attr, F.lit(' href="/images/docs/'), (k / 2).cast("bigint").cast("string"),
        F.lit('.pdf">Descargar</a>')))
    raw = _iso_raw(k, ts)
    tm = F.when(raw.isNull(), F.lit("")).otherwise(F.concat(F.lit('<time itemprop="datePublished" datetime="'), raw, F.lit('">f</time>')))
    return F.concat(F.lit('<tr class="docman_item"><td>'), a, F.lit("</td><td>"), tm, F.lit("</td></tr>"))


def render_tables(spark, sf, source: str) -> DataFrame:
    """Table pages: a paged table of TABLE_ROWS consecutive order keys, rows in key order.

    Pages are bounded whatever the key distribution; page order then row order is key order."""
    o = T(spark, sf, "orders")
    k = _k()
    row = _row_bolivia(k, F.col("o_orderstatus")) if source == "bolivia" else _row_costarica(k, _ts_of_order(o))
    rows = o.select((k / TABLE_ROWS).cast("bigint").alias("page_id"), k.alias("k"), row.alias("row"))
    pages = rows.groupBy("page_id").agg(F.expr("listagg(row, '') within group (order by k)").alias("rows"))
    head = "<tr><th>N°</th><th>Descripción</th><th>Fecha</th><th>Ver</th></tr>" if source == "bolivia" else ""
    tail = '<tr><td colspan="4">Total</td></tr>' if source == "bolivia" else ""
    return pages.select("page_id", F.lit("tabla").alias("categoria"), F.lit(1).alias("categoria_rank"),
                        F.concat(F.lit(f"<html><body><table>{head}"), F.col("rows"), F.lit(f"{tail}</table></body></html>")).alias("html"))


def q_rows_bolivia(spark, sf):
    r = PR.rows_bolivia(dealt(render_tables(spark, sf, "bolivia"), "page_id", _dealt(spark)), RUN_YEAR)
    return r.select("url", "titulo", "fecha")


def q_rows_costarica(spark, sf):
    r = PR.rows_costarica(dealt(render_tables(spark, sf, "costarica"), "page_id", _dealt(spark)), RUN_YEAR)
    return r.select("url", "titulo", "fecha")


# ------------------------------------------------------------------------ generic HTML

def _pages(spark, sf):
    p = T(spark, sf, "pages").select("page_id", "html")
    return dealt(p, "page_id", spread(p))


def q_html_blocks(spark, sf):
    rows = shred(_pages(spark, sf)).where(F.col("kind") == "el")
    return rows.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n_elements"),
        F.count_if(F.col("tag") == "p").alias("n_p"),
        F.count_if(F.col("tag") == "a").alias("n_a"),
        F.count_if(F.col("tag") == "li").alias("n_li"),
    )


HTML_SELECT = RecordSpec(None, {
    "title": Field("title", "text_b"),
    "h1": Field("h1", "text_c"),
    "nav_href": Field("nav li a", "attr:href"),
    "nav_text": Field("nav li a", "text_b"),
    "ad": Field("div.ad", "text_b"),
    "footer": Field("footer", "text_c"),
})


def q_html_select(spark, sf):
    r = page_records(_pages(spark, sf), "page_id", HTML_SELECT)
    return r.select("page_id", "title", "h1", "nav_href", "nav_text", "ad", "footer")


def q_element_text_modes(spark, sf):
    spec = RecordSpec(None, {"a": Field("nav ul", "text_a"), "b": Field("nav ul", "text_b"), "c": Field("nav ul", "text_c")})
    r = page_records(_pages(spark, sf), "page_id", spec)
    return r.select("page_id", F.col("a").alias("text_a"), F.col("b").alias("text_b"), F.col("c").alias("text_c"))


def _page_lang(df):
    return df.withColumn("lang", F.regexp_extract("url", r"/([a-z]{2})/", 1))


def q_rules_scan(spark, sf):
    rules = RU.rules_scan(spark, PAGE_RULES)
    counts = _page_lang(T(spark, sf, "pages").select("page_id", "url")).groupBy("lang").agg(F.count(F.lit(1)).alias("n_pages"))
    j = rules.join(counts, rules.key == counts.lang, "inner")
    return j.select("lang", "content_type", F.col("container_sel").alias("container"),
                    F.array_join("selectors_sel", "|").alias("selectors"), F.array_join("remove_sel", "|").alias("remove"), "n_pages")


def q_rules_join(spark, sf):
    p = _page_lang(T(spark, sf, "pages").select("page_id", "url"))
    j = RU.with_rules(p, RU.rules_bundled(spark, PAGE_RULES), "lang")
    return j.select("page_id", "lang", "content_type", F.col("container_sel").alias("container"),
                    F.array_join("selectors_sel", "|").alias("selectors"), F.array_join("remove_sel", "|").alias("remove"))


def q_html_content(spark, sf):
    p = _page_lang(T(spark, sf, "pages").select("page_id", "url", "html"))
    ruled = RU.with_rules(dealt(p, "page_id", spread(p)), RU.rules_bundled(spark, PAGE_RULES), "lang")
    return page_content(ruled, "page_id", keep=["lang"])


# ------------------------------------------------------------------------ detail pages

DETAIL_BASE = "https://www.digemid.example.gob.pe/alertas/"


def render_details(spark, sf) -> DataFrame:
    p = T(spark, sf, "part")
    k = F.col("p_partkey")
    ks = k.cast("string")
    h3 = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<h3> "), _esc(F.col("p_name")), F.lit(" </h3>")))
    ul = F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("<ul><li>"), _esc(F.col("p_brand")), F.lit("</li>\n<li> "),
                                                         _esc(F.col("p_type")), F.lit(" </li></ul>")))
    pdf = (F.when(k % 4 == 0, F.lit('<a href="/contacto.html">contacto</a>'))
           .when(k % 10 == 0, F.concat(F.lit('<img src="docs/'), ks, F.lit('.pdf" href="info.html">')))
           .when(k % 6 == 0, F.concat(F.lit('<iframe src="docs/'), ks, F.lit('.pdf"></iframe>')))
           .when(k % 9 == 0, F.concat(F.lit('<a href="../files/'), ks, F.lit('.pdf">pdf</a>')))
           .otherwise(F.concat(F.lit('<a href="/docs/'), ks, F.lit('.pdf">pdf</a>'))))
    html = F.concat(F.lit('<html><body><div class="entry-content"><p>Aviso</p>'), h3, ul, pdf,
                    F.lit('</div><div class="sidebar"><h3>Otros</h3><ul><li>x</li></ul><a href="/otros.pdf">o</a></div></body></html>'))
    return p.select(k.alias("page_id"), F.concat(F.lit(DETAIL_BASE), ks, F.lit("/")).alias("url"), html.alias("html"))


def _details(spark, sf):
    p = render_details(spark, sf)
    return PR.detail_fields(dealt(p, "page_id", spread(p)))


def q_detail_fields(spark, sf):
    return _details(spark, sf).select("page_id", "url", "motivo", "producto", "pdf")


def _listing_docs(spark, sf):
    d = T(spark, sf, "documents")
    return d.select("doc_id", F.concat(F.lit(DETAIL_BASE), (F.col("doc_id") * 3).cast("string"), F.lit("/")).alias("url"),
                    F.concat(F.col("source"), F.lit(" #"), F.col("doc_id").cast("string")).alias("titulo"))


def q_detail_join(spark, sf):
    j = PR.feed_with_detail(_listing_docs(spark, sf), _details(spark, sf))
    return j.select("doc_id", "url", "motivo", "producto", "pdf", "fatal")


def q_title_composite(spark, sf):
    j = PR.feed_with_detail(_listing_docs(spark, sf), _details(spark, sf))
    return j.select("doc_id", "titulo")


# ------------------------------------------------------------------------ history

def _history_csv_path(spark, sf) -> str:
    # a folder of its own for each run, under the shared folder the cluster names
    return f"{checkpoint_dir(spark)}/history-csv-{uuid.uuid4().hex}"


def _docs_as_history(spark, sf):
    d = T(spark, sf, "documents")
    return d.select(F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"), F.col("text").alias("titulo"),
                    F.col("lang").alias("fecha"), F.col("source").alias("institucion"))


def q_history_scan(spark, sf):
    path = _history_csv_path(spark, sf)
    HS.write_history_csv(_docs_as_history(spark, sf), path)
    return HS.read_history_csv(spark, path)


def q_history_backfill(spark, sf):
    return HS.backfill(_docs_as_history(spark, sf)).select("url", "titulo", "fecha", "pais", "institucion", "resumen")


def _event_alerts(spark, sf, empty_keys=False):
    e = T(spark, sf, "events")
    url = F.concat(F.lit("https://alerts.example.org/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"))
    if empty_keys:
        url = F.when(F.col("event_id") % 50 == 0, F.lit("")).otherwise(url)
    return e.select(
        url.alias("url"), F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("titulo"),
        F.date_format("ts", "dd-MM-yyyy HH:mm").alias("fecha"), F.col("event_type").alias("pais"),
        F.concat(F.lit("inst"), (F.col("user_id") % 5).cast("string")).alias("institucion"),
        F.lit(1).alias("source_rank"), F.col("event_id").alias("item_pos"), F.col("user_id"))


def _event_history(spark, sf):
    a = _event_alerts(spark, sf).where(F.col("user_id") % 3 == 0)
    h = H.keep_first(a, "url", ["item_pos"], ["titulo", "fecha", "pais", "institucion", "source_rank", "item_pos"])
    return h.withColumn("resumen", F.lit(""))


def q_novelty(spark, sf):
    n = H.novelty(_event_alerts(spark, sf), _event_history(spark, sf))
    return n.select("url", "titulo", "fecha", "pais", "institucion", "resumen", "item_pos")


def q_history_merge(spark, sf):
    hist = _event_history(spark, sf)
    news = H.novelty(_event_alerts(spark, sf).drop("user_id"), hist)
    m = H.merge_history(hist, news)
    return m.select("url", "titulo", "resumen", "item_pos")


def q_dedupe_last(spark, sf):
    a = _event_alerts(spark, sf, empty_keys=True).select("url", "titulo", "item_pos")
    return H.dedupe_last(a)


def q_run_counters(spark, sf):
    cand = _event_alerts(spark, sf).drop("user_id")
    hist = _event_history(spark, sf)
    news = H.novelty(cand, hist)
    merged = H.merge_history(hist, news)
    content = C.doc_first_pages(T(spark, sf, "conversations"), "conv_id", "turn", "text", max_pages=3)
    return H.run_counters(hist, cand, news, merged, content)


# ------------------------------------------------------------------------ catalogue, gate, union

def q_source_catalogue(spark, sf):
    from ..sources.catalogue import catalogue
    known = T(spark, sf, "documents").groupBy((F.col("doc_id") % 8 + 1).cast("int").alias("source_rank")).agg(F.count("*").alias("n_known"))
    return catalogue(spark, CATALOGUE_YEAR).join(known, "source_rank", "left")


def _pages_with_status(spark, sf):
    p = T(spark, sf, "pages").select("page_id", "url")
    return p.withColumn("status", F.when(F.col("page_id") % 17 == 0, F.lit(404)).otherwise(F.lit(200))).withColumn("host", host_of("url"))


def q_status_gate(spark, sf):
    return E.status_gate(_pages_with_status(spark, sf)).select("page_id", "url")


def _fatal_pages(spark, sf):
    p = _pages_with_status(spark, sf)
    return p.withColumn("fatal", F.when(F.col("status") != 200, F.concat(F.lit("HTTP "), F.col("status").cast("string"))))


def q_drop_failed_groups(spark, sf):
    return E.drop_failed_groups(_fatal_pages(spark, sf), ["host"]).select("page_id", "url", "host")


def q_quarantine(spark, sf):
    _, bad = E.quarantine(_fatal_pages(spark, sf))
    return bad.select("page_id", "url", "host", F.col("fatal").alias("error"))


def q_union_sources(spark, sf):
    d = T(spark, sf, "documents").select("doc_id")
    frames = []
    for i, sid in enumerate(PR.PROFILES):
        p = PR.PROFILES[sid]
        f = d.where(F.col("doc_id") % 8 == i).select(
            "doc_id", F.concat(F.lit(f"https://{sid}.example.org/"), F.col("doc_id").cast("string")).alias("url"),
            F.lit(p.pais).alias("pais"), F.lit(p.institucion).alias("institucion"), F.lit(p.source_rank).alias("source_rank"))
        if sid == "peru":
            f = f.withColumn("pdf", F.concat(F.lit("https://peru.example.org/"), F.col("doc_id").cast("string"), F.lit(".pdf")))
        frames.append(f)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------------ content, summary, notify

def _doc_alerts(spark, sf):
    d = T(spark, sf, "documents")
    k = F.col("doc_id")
    pais = F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]), (k % 8 + 1).cast("int"))
    pdf = (F.when(k % 3 == 0, F.concat(F.lit("https://docs.example.org/pdf/"), k.cast("string"), F.lit(".pdf")))
           .when(k % 3 == 1, F.lit("")).otherwise(F.lit(None).cast("string")))
    return d.select("doc_id", F.concat(F.lit("https://docs.example.org/"), F.col("source"), F.lit("/"), k.cast("string")).alias("url"),
                    pdf.alias("pdf"), F.concat(F.col("source"), F.lit(" #"), k.cast("string")).alias("titulo"),
                    F.col("lang").alias("fecha"), pais.alias("pais"),
                    F.concat(F.lit("Agencia <"), F.col("source"), F.lit("> & \"co\" 'x'")).alias("institucion"), "text")


def _routed(spark, sf):
    a = _doc_alerts(spark, sf)
    return C.content_route(RU.with_rules(a, RU.rules_from_dict(spark, RU.COUNTRY_RULES), "pais"))


def q_content_route(spark, sf):
    return _routed(spark, sf).select("doc_id", "pais", "content_type", "content_key")


def _content_table(spark, sf):
    """Every document's text; a third of the fetches failed (no content, the title is used)."""
    r = _routed(spark, sf).withColumn("status", F.when(F.col("doc_id") % 3 == 2, 404).otherwise(200))
    return C.one_per_key(E.status_gate(r).where(F.col("content_key").isNotNull()).select("content_key", F.col("text").alias("content")), "content_key")


def q_enrich(spark, sf):
    e = C.enrich(_routed(spark, sf).drop("text"), _content_table(spark, sf))
    return e.select("doc_id", "resumen")


def q_summary_fallback(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text", "source")
    lab = T(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    summ = (F.when(F.col("toxic") == 1, F.lit(" \t "))
            .when(F.col("quality").isNotNull(), C.default_summariser(F.col("text"), F.lit(None))))
    titulo = F.concat(F.col("source"), F.lit(" #"), F.col("doc_id").cast("string"))
    return j.select("doc_id", C.summary_fallback(summ, titulo).alias("resumen"))


def q_summary_lead(spark, sf):
    d = T(spark, sf, "documents")
    return d.select("doc_id", C.default_summariser(F.col("text"), F.lit(None)).alias("summary"))


def q_summary_extractive(spark, sf):
    return extractive_summaries(T(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")


def q_doc_first_pages(spark, sf):
    return C.doc_first_pages(T(spark, sf, "conversations"), "conv_id", "turn", "text", max_pages=3)


def q_outbox(spark, sf):
    a = _doc_alerts(spark, sf).drop("text").withColumn("resumen", F.col("titulo"))
    return N.outbox(a, batch_id=0)


def q_outbox_silent(spark, sf):
    a = _doc_alerts(spark, sf).drop("text").withColumn("resumen", F.col("titulo"))
    return N.outbox(a, batch_id=0, silent=True)


# ------------------------------------------------------------------------ report

def _report_history(spark, sf):
    e = T(spark, sf, "events")
    fecha = F.when(F.col("event_id") % 9 == 0, F.lit("Sin Fecha")).otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm"))
    return e.select(F.concat(F.lit("https://alerts.example.org/e/"), F.col("event_id").cast("string")).alias("url"),
                    F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("titulo"),
                    fecha.alias("fecha"), F.col("event_type").alias("pais"),
                    F.concat(F.lit("inst"), (F.col("user_id") % 5).cast("string")).alias("institucion"))


def _report(spark, sf):
    return R.prepare(_report_history(spark, sf), MIN_DATE)


def q_dash_dates(spark, sf):
    return R.with_report_date(_report_history(spark, sf)).select("url", "fecha")


def q_dash_filter(spark, sf):
    return _report(spark, sf).select("url", "fecha", "pais")


def q_dash_select(spark, sf):
    return R.select_countries(_report(spark, sf), SELECTION).select("url", "fecha", "pais")


def q_dash_select_all(spark, sf):
    return R.select_countries(_report(spark, sf), []).select("url", "fecha", "pais")


def q_kpis(spark, sf):
    return R.kpis(R.select_countries(_report(spark, sf), SELECTION))


def q_by_country(spark, sf):
    return R.by_country(_report(spark, sf))


def q_by_day(spark, sf):
    return R.by_day(_report(spark, sf), DAY_CUTOFF)


def q_countries(spark, sf):
    return R.countries(_report(spark, sf))


def q_detail(spark, sf):
    return R.detail(_report(spark, sf))


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}
