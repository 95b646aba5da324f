"""The whole job over rendered fetches of all eight sources, with its SQL.

Every order of the given table is one alert of one source (order key mod 8); its listing entry,
feed item, detail page, web page or document pages are rendered from the order's columns, grouped
into bounded pages. Some fetches fail, some feed items have no link, some pages were fetched before
and have changed since, a third of the alerts is already in history: this is the fixture of
novelty, the error policy and the stores, not a way to read less.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import content as C
from ..operators.notify import DEFAULT_FLAG, FLAGS
from ..session import checkpoint_dir
from ..sources import rules as RU
from ..sources.alert_store import AlertStore
from ..sources.content_store import ContentStore
from ..streaming import stateful
from . import job
from . import standins as S
from .oracles import ORACLES as STANDIN_ORACLES
from .oracles import CR_TITLE, ISO_FECHA, ISO_PARSED, MEXICO_FECHA, ORDER_TS, esc

BLOCK = 320  # consecutive order keys a page covers (40 a source, split by category)
SOURCES = ["peru", "chile", "brasil", "colombia", "mexico", "argentina", "bolivia", "costarica"]
CHILE = "https://www.ispch.example.gob.cl/alertas/"
RENDER = {"brasil": S._card_brasil, "colombia": S._card_colombia, "mexico": S._card_mexico, "argentina": S._card_argentina}


def _orders(spark, sf) -> DataFrame:
    o = S.T(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select("*", k.alias("k"), S._ts_of_order(o).alias("ts"), F.element_at(F.array(*map(F.lit, SOURCES)), (k % 8 + 1).cast("int")).alias("source_id"),
                    F.col("o_orderpriority").alias("categoria"), F.substring("o_orderpriority", 1, 1).cast("int").alias("categoria_rank"),
                    F.floor(k / BLOCK).alias("block"))


def _status():
    return F.when((F.col("block") + F.col("categoria_rank")) % 23 == 0, 500).otherwise(200).alias("status")


def _paged(entries: DataFrame, sep: str, head: F.Column, tail: F.Column, name: str) -> DataFrame:
    pages = entries.groupBy("source_id", "categoria", "categoria_rank", "block").agg(
        F.expr(f"listagg(entry, '{sep}') within group (order by k)").alias("entries"))
    return pages.select("source_id", ((F.col("block") * 10 + F.col("categoria_rank")) * 10).alias("page_id"), "categoria", "categoria_rank",
                        _status(), F.concat(head, F.col("entries"), tail).alias(name))


def listing_pages(spark, sf) -> DataFrame:
    o, k, ts = _orders(spark, sf), F.col("k"), F.col("ts")
    entry = F.lit(None).cast("string")
    for source, render in RENDER.items():
        entry = F.when(F.col("source_id") == source, render(k, ts)).otherwise(entry)
    entry = F.when(F.col("source_id") == "bolivia", S._row_bolivia(k, F.col("o_orderstatus"))).otherwise(entry)
    entry = F.when(F.col("source_id") == "costarica", S._row_costarica(k, ts)).otherwise(entry)
    return _paged(o.select("*", entry.alias("entry")).where("entry is not null"), "", F.lit("<html><body><div><table>"), F.lit("</table></div></body></html>"), "html")


def feed_docs(spark, sf, every_link: bool = False) -> DataFrame:
    """Feeds of Peru and Chile. Some items of Chile have no link; with ``every_link`` such an item comes
    beside the alert's own, so that every alert of the source can be sent."""
    o, k = _orders(spark, sf).where(F.col("source_id").isin("peru", "chile")), F.col("k")
    link = F.concat(F.when(F.col("source_id") == "peru", F.lit(S.DETAIL_BASE)).otherwise(F.lit(CHILE)), k.cast("string"), F.lit("/"))
    date = F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("<pubDate>"), F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate>")))
    no_link = (F.col("source_id") == "chile") & (k % 19 == 0)
    item = lambda at: F.concat(F.lit("<item><title>Alerta "), k.cast("string"), F.lit("</title>"), at, date, F.lit("</item>"))
    linked, bare = item(F.concat(F.lit("<link>"), link, F.lit("</link>"))), item(F.lit(""))
    entry = F.when(no_link, F.concat(linked, bare) if every_link else bare).otherwise(linked)
    return _paged(o.select("*", entry.alias("entry")), "", F.lit("<rss version=\"2.0\"><channel>"), F.lit("</channel></rss>"), "xml")


def detail_pages(spark, sf) -> DataFrame:
    """Peru's detail pages; some were fetched twice, some failed."""
    o, k = _orders(spark, sf).where("source_id = 'peru'"), F.col("k")
    ks = k.cast("string")
    h3 = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<h3>Dosis "), ks, F.lit(" < 10 mg</h3>")))
    ul = F.when(k % 3 == 1, F.lit("")).otherwise(F.concat(F.lit("<ul><li>Lote "), ks, F.lit("</li></ul>")))
    pdf = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit('<a href=" /docs/'), ks, F.lit('.pdf">pdf</a>')))
    html = F.concat(F.lit('<html><body><div class="entry-content">'), h3, ul, pdf, F.lit("</div></body></html>"))
    once = o.select(k.alias("page_id"), F.concat(F.lit(S.DETAIL_BASE), ks, F.lit("/")).alias("url"),
                    F.when(k % 17 == 0, 404).otherwise(200).alias("status"), html.alias("html"), "k")
    twice = once.where("k % 13 = 0").withColumn("page_id", -F.col("page_id"))
    return once.unionByName(twice).drop("k")


def _urls() -> F.Column:
    k, ks = F.col("k"), F.col("k").cast("string")
    third, half = F.floor(k / 3).cast("string"), F.floor(k / 2).cast("string")
    forms = {"peru": F.concat(F.lit(S.DETAIL_BASE), ks, F.lit("/")), "chile": F.concat(F.lit(CHILE), ks, F.lit("/")),
             "brasil": F.concat(F.lit("/alertas/"), ks), "colombia": F.concat(F.lit("/files/"), ks, F.lit(".pdf")),
             "mexico": F.concat(F.lit("https://www.gob.mx/cofepris/documentos/"), ks, F.lit(".pdf")),
             "argentina": F.concat(F.lit("https://www.argentina.gob.ar/anmat/alertas/"), ks),
             "bolivia": F.concat(F.lit("https://www.agemed.gob.bo/archivo/"), third, F.lit(".pdf")),
             "costarica": F.concat(F.lit("https://www.ministeriodesalud.go.cr/images/docs/"), half, F.lit(".pdf"))}
    out = F.lit(None).cast("string")
    for s, u in forms.items():
        out = F.when(F.col("source_id") == s, u).otherwise(out)
    return out


def _fetched(day: int) -> F.Column:
    return (F.lit(f"2024-06-{day:02d} 00:00:00").cast("timestamp") + F.make_interval(secs=F.col("k") % 3600)).alias("fetched_at")


def web_pages(spark, sf, day: int = 2) -> DataFrame:
    """Web pages of the alerts whose content is on the page; every fifth has none of its markup. Those
    fetched on an earlier day (a quarter) said something else."""
    o, ks = _orders(spark, sf).where(F.col("source_id").isin("brasil", "argentina")), F.col("k").cast("string")
    said = F.lit("Texto") if day > 1 else F.lit("Antes")
    brasil = F.concat(F.lit('<div class="bodyModel"><div><h4>Aviso '), ks, F.lit("</h4><p>"), said, F.lit(" <a>aqui</a> de "), F.col("o_custkey").cast("string"), F.lit("</p></div></div>"))
    argentina = F.concat(F.lit('<div class="title-description"><h1>Aviso '), ks, F.lit('</h1></div><div class="news__lead"><p>'), said, F.lit(" de "),
                         F.col("o_custkey").cast("string"), F.lit("</p></div>"))
    html = F.when((F.col("k") % 5 == 0) & F.lit(day > 1), F.lit("<p>nada</p>")).when(F.col("source_id") == "brasil", brasil).otherwise(argentina)
    o = o if day > 1 else o.where("floor(k / 8) % 4 = 0")
    return o.select(_urls().alias("url"), F.concat(F.lit("<html><body>"), html, F.lit("<footer>f</footer></body></html>")).alias("html"), _fetched(day))


def doc_pages(spark, sf, day: int = 2) -> DataFrame:
    """Page texts of the documents (Peru: of the detail page's file); every fifth has none. A quarter
    was fetched on an earlier day too, with other texts."""
    o, k = _orders(spark, sf).where(~F.col("source_id").isin("brasil", "argentina") & (F.col("k") % 5 != 0)), F.col("k")
    url = F.when(F.col("source_id") == "peru", F.concat(F.lit(S.DETAIL_BASE.split("/alertas/")[0] + "/docs/"), k.cast("string"), F.lit(".pdf"))).otherwise(_urls())
    texts = F.array(F.concat(F.lit("Documento "), k.cast("string")), F.lit(""), F.concat(F.lit(" cliente  "), F.col("o_custkey").cast("string")), F.lit("fuera"))
    if day < 2:
        o, texts = o.where("floor(k / 8) % 4 = 0"), F.array(*map(F.lit, ("Borrador", "viejo", "texto", "fuera")))
    return o.select(url.alias("url"), _fetched(day), F.posexplode(texts).alias("page_no", "text"))


def history(spark, sf) -> DataFrame:
    o = _orders(spark, sf).where("k % 3 = 0")
    return o.select(_urls().alias("url"), F.lit("previa").alias("titulo"), F.lit("").alias("resumen"), F.lit("Previo").alias("pais"))


def _stores(spark, sf) -> tuple[AlertStore, ContentStore]:
    """A store with the links of earlier runs, and the fetches of two days."""
    root = f"{checkpoint_dir(spark)}/vigia-job/store-{uuid.uuid4().hex}"
    store, content = AlertStore(spark, root), ContentStore(spark, root + "/content")
    store.add(history(spark, sf))
    for day in (2, 1):  # the newest fetch counts, whichever was stored last
        content.add(day, web_pages(spark, sf, day), doc_pages(spark, sf, day))
    return store, content


def _collected(spark, sf, every_link: bool = False) -> tuple[DataFrame, DataFrame]:
    return job.collect(listing_pages(spark, sf), feed_docs(spark, sf, every_link), detail_pages(spark, sf), S.RUN_YEAR, partitions=S._dealt(spark))


def _rules(spark) -> DataFrame:
    return RU.rules_from_dict(spark, RU.COUNTRY_RULES)


def _run(spark, sf, every_link: bool = False) -> AlertStore:
    store, content = _stores(spark, sf)
    job.run_on(store, _collected(spark, sf, every_link)[0], content, _rules(spark), max_pages=3, partitions=S._dealt(spark))
    return store


def q_job_outbox(spark, sf):
    """The messages that a run over all eight sources committed."""
    return _run(spark, sf, every_link=True).outbox().select("url", "message", "batch_id")


def q_job_history(spark, sf):
    """The history after the run (K1), read back."""
    return _run(spark, sf, every_link=True).history().select("url", "titulo", "resumen", "pais")


def q_job_counters(spark, sf):
    """A10: what the run's commit says of it."""
    c = F.col("counters")
    return _run(spark, sf).commits().where("size(sent) > 0").select(*[c[n].alias(n) for n in ("history_rows", "candidate_rows", "novelty_rows", "stored_rows", "content_chars")])


def q_job_quarantine(spark, sf):
    """Everything the run could not use, with the reason."""
    return _collected(spark, sf)[1].select("source_id", "categoria", "page_id", "url", F.col("fatal").alias("error"))


def q_job_content(spark, sf):
    """J4 + S9: the newest content of the links that the run's news want, from a store of two days."""
    store, content = _stores(spark, sf)
    routed = C.content_route(RU.with_rules(store.novelty(_collected(spark, sf)[0]), _rules(spark), "pais"))
    return job.content_table(routed, content, _rules(spark), max_pages=3, partitions=S._dealt(spark))


def q_stream_novelty(spark, sf):
    """The history after three runs of the stream, each restarted from its checkpoint, over thirds
    of the candidates in order; the links of earlier jobs are the initial state."""
    root = f"{checkpoint_dir(spark)}/vigia-job/stream-{uuid.uuid4().hex}"
    store = AlertStore(spark, root + "/store")
    store.add(S._event_history(spark, sf))
    rows = S._event_alerts(spark, sf).drop("user_id")
    last = rows.agg(F.max("item_pos")).first()[0]
    for third in range(3):
        rows.where(F.floor(F.col("item_pos") * 3 / F.lit(last + 1)) == third).write.mode("append").parquet(root + "/in")
        stateful.start(spark, root + "/in", rows.schema, store, root + "/checkpoint").awaitTermination()
    return store.history().select("url", "titulo", "resumen", "item_pos")


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}

# ---- SQL -----------------------------------------------------------------------------------

_HOST = S.DETAIL_BASE.split("/alertas/")[0]
_URL = f"""CASE k % 8 WHEN 0 THEN '{S.DETAIL_BASE}' || k || '/' WHEN 1 THEN '{CHILE}' || k || '/' WHEN 2 THEN '/alertas/' || k
    WHEN 3 THEN '/files/' || k || '.pdf' WHEN 4 THEN 'https://www.gob.mx/cofepris/documentos/' || k || '.pdf'
    WHEN 5 THEN 'https://www.argentina.gob.ar/anmat/alertas/' || k WHEN 6 THEN 'https://www.agemed.gob.bo/archivo/' || (k // 3) || '.pdf'
    ELSE 'https://www.ministeriodesalud.go.cr/images/docs/' || (k // 2) || '.pdf' END"""
_PERU = """'Alerta ' || k || ' - ' || CASE WHEN k % 5 = 0 THEN 'Sin detalle en H3' ELSE 'Dosis ' || k || ' < 10 mg' END
    || CASE WHEN k % 3 = 1 THEN '' ELSE '. Productos: Lote ' || k END"""
_FEED_FECHA = f"CASE WHEN k % 7 = 0 THEN 'Sin Fecha' ELSE strftime({ORDER_TS}, '%d-%m-%Y %H:%M:%S') END"
_BASE = f"""(SELECT *, o_orderkey AS k, CAST(o_orderpriority[1] AS INTEGER) AS categoria_rank,
    ((o_orderkey // {BLOCK}) + CAST(o_orderpriority[1] AS INTEGER)) % 23 = 0 AS failed FROM orders)"""
_CHILE_LINKED = "k % 19 <> 0"  # alerts of Chile whose only feed item has a link
_ALERTS = f"""(SELECT k, {_URL} AS url, {CR_TITLE} AS cr,
    CASE k % 8 WHEN 0 THEN {_PERU} WHEN 1 THEN 'Alerta ' || k WHEN 2 THEN 'Alerta ' || k || ' & retiro' WHEN 3 THEN 'Alerta ' || k || ' & retiro'
        WHEN 4 THEN 'Alerta ' || k WHEN 5 THEN CASE WHEN k % 11 = 0 THEN 'Sin título' ELSE 'Alerta ' || k || '&retiro' END
        WHEN 6 THEN k || ' - Alerta & ' || o_orderstatus ELSE {CR_TITLE} END AS titulo,
    CASE k % 8 WHEN 0 THEN {_FEED_FECHA} WHEN 1 THEN {_FEED_FECHA}
        WHEN 2 THEN CASE WHEN k % 13 = 0 THEN '31/02/' || year(o_orderdate) ELSE strftime({ORDER_TS}, '%d-%m-%Y %H:%M') END
        WHEN 3 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 4 THEN {MEXICO_FECHA} WHEN 5 THEN {ISO_FECHA}
        WHEN 6 THEN strftime(o_orderdate, '%d-%m-%Y') ELSE {ISO_FECHA} END AS fecha,
    ['Perú', 'Chile', 'Brasil', 'Colombia', 'México', 'Argentina', 'Bolivia', 'Costa Rica'][k % 8 + 1] AS pais,
    ['DIGEMID', 'ISPCH', 'ANVISA', 'INVIMA', 'COFEPRIS', 'ANMAT', 'AGEMED', 'MinSalud'][k % 8 + 1] AS institucion,
    CASE WHEN k % 5 = 0 THEN NULL WHEN k % 8 = 2 THEN 'Aviso ' || k || ' Texto de ' || o_custkey
        WHEN k % 8 = 5 THEN 'Aviso ' || k || ' Texto de ' || o_custkey ELSE 'Documento ' || k || ' cliente ' || o_custkey END AS content
    FROM {_BASE} WHERE NOT failed AND CASE k % 8 WHEN 0 THEN k % 17 <> 0 AND k % 11 <> 0 WHEN 1 THEN {_CHILE_LINKED} WHEN 2 THEN k % 11 <> 0
        WHEN 3 THEN k % 11 <> 0 AND k % 13 <> 0 WHEN 4 THEN k % 11 <> 0 WHEN 5 THEN true
        WHEN 6 THEN k % 13 <> 0 AND k % 11 <> 0 AND year(o_orderdate) = {S.RUN_YEAR}
        ELSE k % 11 <> 0 AND (NOT {ISO_PARSED} OR year({ORDER_TS}) = {S.RUN_YEAR}) END)"""
_FLAG = "CASE pais " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FLAGS.items()) + f" ELSE '{DEFAULT_FLAG}' END"
_NEWS = f"(SELECT *, coalesce(content, titulo) AS resumen FROM {_ALERTS} WHERE k % 3 <> 0)"
_NEWS_EVERY_LINK = _NEWS.replace(_CHILE_LINKED, "true")  # every alert of Chile has an item with its link
ORACLES = {
    "stream_novelty": STANDIN_ORACLES["history_merge"],
    "job_outbox": f"""SELECT url, {_FLAG} || ' <b>NUEVA ALERTA - ' || pais || '</b>' || chr(10) || '🏛 <b>Institución:</b> ' || institucion
        || chr(10) || '📅 <b>Fecha:</b> ' || fecha || chr(10) || chr(10) || '⚠️ <b>' || {esc('resumen')} || '</b>' || chr(10) || chr(10)
        || '🔗 ' || url AS message, '0' AS batch_id FROM {_NEWS_EVERY_LINK}""",
    "job_history": f"""SELECT {_URL} AS url, 'previa' AS titulo, '' AS resumen, 'Previo' AS pais FROM {_BASE} WHERE k % 3 = 0
        UNION ALL SELECT url, titulo, resumen, pais FROM {_NEWS_EVERY_LINK}""",
    "job_quarantine": f"""WITH b AS (SELECT *, {SOURCES}[k % 8 + 1] AS source_id, ((k // {BLOCK}) * 10 + categoria_rank) * 10 AS page_id FROM {_BASE})
        SELECT DISTINCT source_id, o_orderpriority AS categoria, page_id, NULL AS url, 'HTTP 500' AS error FROM b WHERE failed
        UNION ALL SELECT source_id, o_orderpriority, page_id, CASE WHEN k % 8 <> 1 THEN {_URL} END, CASE WHEN k % 8 = 1 THEN 'no link' WHEN k % 8 = 3 THEN 'bad date: ' || year(o_orderdate) || '-13-45'
            WHEN k % 17 = 0 THEN 'detail page missing' ELSE 'no pdf link on detail page' END
        FROM b WHERE NOT failed AND ((k % 8 = 0 AND (k % 17 = 0 OR k % 11 = 0)) OR (k % 8 = 1 AND k % 19 = 0) OR (k % 8 = 3 AND k % 13 = 0 AND k % 11 <> 0))""",
    "job_counters": f"""SELECT (SELECT count(*) FROM {_BASE} WHERE k % 3 = 0) AS history_rows, (SELECT count(*) FROM {_ALERTS}) AS candidate_rows,
        count(*) AS novelty_rows, count(DISTINCT url) AS stored_rows, CAST(coalesce(sum(length(content)), 0) AS BIGINT) AS content_chars FROM {_NEWS}""",
    "job_content": f"""SELECT CASE WHEN k % 8 = 0 THEN '{_HOST}/docs/' || k || '.pdf' ELSE url END AS content_key, content FROM {_NEWS}
        WHERE content IS NOT NULL""",
}
