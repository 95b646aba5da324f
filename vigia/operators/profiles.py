"""U1 / S3 / S4 / S6 / F1-F6 / P1 / P4 / W1 / W4 / T1-T4 / T9*: the eight source profiles.

Each profile is data (container and field selectors, date policy, constants) plus a short
DataFrame function that turns shredded listing pages into alert rows. Pages of every category of
a source go through one plan: the category is a column, not a loop (U-2).

Input rows come from :func:`vigia.operators.shred.shred` with the page columns ``categoria``,
``categoria_rank`` kept. Output rows follow :data:`vigia.sources.history.ALERT_SCHEMA` plus
``fatal`` (a reason when the reference would lose the whole source on this row).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import POLICIES, apply_policy, current_year_filter
from ..functions.text import clean_title_costarica, clean_title_mexico, composite_title, first_8_digits, strip_ws
from ..functions.urls import absolute_url
from .history import dedupe_last
from .masks import page_records
from .select import Field, RecordSpec, extract_records


@dataclass(frozen=True)
class Profile:
    source_id: str
    source_rank: int
    pais: str
    institucion: str
    spec: RecordSpec | None = None
    base_url: str | None = None
    extra: dict = field(default_factory=dict)


# Sources, their order, constants, selectors and link bases.
PROFILES = {
    "peru": Profile("peru", 1, "Perú", "DIGEMID",
                    RecordSpec(None, {
                        "motivo": Field("div.entry-content h3", "text_a"),
                        "producto": Field("div.entry-content ul", "text_a"),
                        "pdf_href": Field('[href$=".pdf"], [src$=".pdf"]', "attr:href"),
                        "pdf_src": Field('[href$=".pdf"], [src$=".pdf"]', "attr:src"),
                    })),
    "chile": Profile("chile", 2, "Chile", "ISPCH"),
    "brasil": Profile("brasil", 3, "Brasil", "ANVISA",
                      RecordSpec("div|row-fluid+lista-noticias", {
                          "href": Field("div.titulo-resumo p.titulo a", "attr:href"),
                          "titulo": Field("div.titulo-resumo p.titulo a", "text_b"),
                          "fecha_raw": Field("div.span3.data-hora p.data .icon-calendar", "text_b", parent=True),
                          "hora_raw": Field("div.span3.data-hora p.hora .icon-time", "text_b", parent=True),
                      })),
    "colombia": Profile("colombia", 4, "Colombia", "INVIMA",
                        RecordSpec("div.alertas-invima-list", {
                            "titulo": Field("div.views-field-title span.field-content", "text_b"),
                            "fecha_raw": Field("div.views-field-field-a-o div.field-content", "text_b"),
                            "href": Field("span.views-field-field-comunicado-invima a", "attr:href"),
                        })),
    "mexico": Profile("mexico", 5, "México", "COFEPRIS",
                      RecordSpec("li|clearfix+documents", {
                          "titulo": Field("div.col-md-10", "text_b"),
                          "href": Field("div.col-md-2 a", "attr:href"),
                      }), base_url="https://www.gob.mx"),
    "argentina": Profile("argentina", 6, "Argentina", "ANMAT",
                         RecordSpec("a|panel+panel-default", {
                             "titulo": Field("h3", "text_a"),
                             "fecha_raw": Field("time", "attr:datetime"),
                         }), base_url="https://www.argentina.gob.ar"),
    "bolivia": Profile("bolivia", 7, "Bolivia", "AGEMED",
                       RecordSpec("tr", {}, cells_tag="td"), base_url="https://www.agemed.gob.bo/"),
    "costarica": Profile("costarica", 8, "Costa Rica", "MinSalud",
                         RecordSpec("tr.docman_item", {
                             "data_title": Field("a.docman_track_download", "attr:data-title"),
                             "href": Field("a.docman_track_download", "attr:href"),
                             "fecha_raw": Field("time[itemprop=datePublished]", "attr:datetime"),
                         }), base_url="https://www.ministeriodesalud.go.cr"),
}
NO_TITLE = "Sin título"
NO_DETAIL = "Sin detalle en H3"
PAGE_KEYS = ["page_id", "categoria", "categoria_rank"]


def _const(df: DataFrame, p: Profile) -> DataFrame:
    return (df.withColumn("pais", F.lit(p.pais)).withColumn("institucion", F.lit(p.institucion))
            .withColumn("source_id", F.lit(p.source_id)).withColumn("source_rank", F.lit(p.source_rank)))


def _truthy(c) -> F.Column:
    return F.coalesce(c, F.lit("")) != ""


def _pos(df: DataFrame) -> DataFrame:
    # position of a record: (source_rank, categoria_rank, page_id, item_pos); the last is the
    # element's place inside its page
    return df.withColumn("item_pos", F.col("card_id").cast("bigint"))


def _records(rows: DataFrame, p: Profile, keep: tuple[str, ...] = ("categoria", "categoria_rank")) -> DataFrame:
    """Records of shredded rows, or of pages (``html``), which are then parsed once, by step masks.
    Either way with ``page_error``: the reason why a page could not be read."""
    if "html" in rows.columns:
        return page_records(rows, "page_id", p.spec, keep=list(keep))
    return extract_records(rows, "page_id", p.spec, keep=list(keep)).withColumn("page_error", F.lit(None).cast("string"))


def _or_unread(cond: F.Column) -> F.Column:
    """``cond``, or the record of a page that could not be read (it goes to the quarantine)."""
    return cond | F.col("page_error").isNotNull()


def _deduped(alerts: DataFrame) -> DataFrame:
    """A9 + F6 by ``url``; pages that could not be read have none, and each stays."""
    unread = F.concat(F.lit("\0"), F.col("page_id").cast("string"))
    out = dedupe_last(alerts.withColumn("_key", F.when(F.col("fatal").isNotNull(), unread).otherwise(F.col("url"))), key="_key")
    return out.drop("_key").select(*alerts.columns)


def cards_brasil(rows: DataFrame) -> DataFrame:
    p = PROFILES["brasil"]
    r = _records(rows, p).where(_or_unread(F.col("href__found") & F.col("fecha_raw__found") & _truthy(F.col("href"))))   # F1
    raw = F.concat(F.col("fecha_raw"), F.lit(" "), F.col("hora_raw"))
    ts, fecha, _ = apply_policy(raw, POLICIES["brasil"], raw_fallback=F.col("fecha_raw"))
    r = r.withColumn("fecha_ts", ts).withColumn("fecha", fecha)
    r = r.withColumn("fatal", F.coalesce("page_error", F.when(~F.col("hora_raw__found"), F.lit("time node missing"))))
    return _const(_pos(r), p).select(F.col("href").alias("url"), "titulo", "fecha", "fecha_ts",
                                     "pais", "institucion", "source_id", "source_rank", *PAGE_KEYS[1:], "page_id", "item_pos", "fatal")


def cards_colombia(rows: DataFrame) -> DataFrame:
    p = PROFILES["colombia"]
    r = _records(rows, p).where(_or_unread(F.col("titulo__found") & F.col("fecha_raw__found") & F.col("href__found") & _truthy(F.col("href"))))
    ts, fecha, status = apply_policy(F.col("fecha_raw"), POLICIES["colombia"])
    r = r.withColumn("fecha_ts", ts).withColumn("fecha", fecha).withColumn(
        "fatal", F.coalesce("page_error", F.when(status != "ok", F.concat(F.lit("bad date: "), F.col("fecha_raw")))))
    return _const(_pos(r), p).select(F.col("href").alias("url"), "titulo", "fecha", "fecha_ts", "pais", "institucion",
                                     "source_id", "source_rank", *PAGE_KEYS[1:], "page_id", "item_pos", "fatal")


def cards_mexico(rows: DataFrame, top_n: int | None = None) -> DataFrame:
    """Cards of the source; ``top_n`` (W1, none by default) keeps the first cards of each category
    in page and document order, before the field filter. The rank limit is pushed below the
    exchange, so a task sends at most ``top_n`` cards of a category."""
    p = PROFILES["mexico"]
    r = _records(rows, p)
    if top_n is not None:
        w = Window.partitionBy("categoria", F.col("page_error").isNull()).orderBy("page_id", "card_id")
        r = r.withColumn("_rn", F.row_number().over(w)).where(_or_unread(F.col("_rn") <= top_n)).drop("_rn")
    r = r.where(_or_unread(F.col("titulo__found") & F.col("href__found") & _truthy(F.col("href"))))
    digits = first_8_digits(F.col("titulo"))
    ts, fecha, _ = apply_policy(digits, POLICIES["mexico"])
    r = (r.withColumn("fecha_ts", ts).withColumn("fecha", fecha)
         .withColumn("url", F.when(F.col("page_error").isNull(), F.concat(F.lit(p.base_url), F.col("href"))))
         .withColumn("titulo", clean_title_mexico(F.col("titulo"))))
    return _const(_pos(r), p).select("url", "titulo", "fecha", "fecha_ts", "pais", "institucion", "source_id",
                                     "source_rank", *PAGE_KEYS[1:], "page_id", "item_pos", F.col("page_error").alias("fatal"))


def cards_argentina(rows: DataFrame) -> DataFrame:
    p = PROFILES["argentina"]
    r = _records(rows, p)
    href = F.try_element_at(F.col("card_attrs"), F.lit("href"))
    ts, fecha, _ = apply_policy(F.nullif(F.col("fecha_raw"), F.lit("")), POLICIES["argentina"])
    r = (r.withColumn("url", F.when(F.col("page_error").isNull(), absolute_url(F.lit(p.base_url), href)))
         .withColumn("titulo", F.when(F.col("titulo__found"), F.col("titulo")).otherwise(F.lit(NO_TITLE)))
         .withColumn("fecha_ts", ts).withColumn("fecha", fecha))
    return _const(_pos(r), p).select("url", "titulo", "fecha", "fecha_ts", "pais", "institucion", "source_id",
                                     "source_rank", *PAGE_KEYS[1:], "page_id", "item_pos", F.col("page_error").alias("fatal"))


def rows_bolivia(rows: DataFrame, run_year: int, dedupe: bool = True) -> DataFrame:
    p = PROFILES["bolivia"]
    r = _records(rows, p).where(_or_unread(F.size("cells") >= 4))                  # F2
    cell = lambda i: F.try_element_at(F.col("cells"), F.lit(i))                      # W4 (1-based here)
    ts, fecha, status = apply_policy(cell(3)["text_a"], POLICIES["bolivia"])
    r = (r.withColumn("fecha_ts", ts).withColumn("fecha", fecha)
         .where(_or_unread((status == "ok") & current_year_filter(F.col("fecha_ts"), run_year, strict=True)))   # D6 + F4
         .withColumn("titulo", F.concat_ws(" - ", cell(1)["text_a"], cell(2)["text_a"]))           # T2
         .withColumn("url", F.when(_truthy(cell(4)["link"]), absolute_url(F.lit(p.base_url), cell(4)["link"]))))
    out = _const(_pos(r), p).select("url", "titulo", "fecha", "fecha_ts", "pais", "institucion", "source_id",
                                    "source_rank", *PAGE_KEYS[1:], "page_id", "item_pos", F.col("page_error").alias("fatal"))
    return _deduped(out) if dedupe else out


def rows_costarica(rows: DataFrame, run_year: int, dedupe: bool = True) -> DataFrame:
    p = PROFILES["costarica"]
    r = _records(rows, p).where(_or_unread(F.col("data_title__found")))             # F3
    titulo = clean_title_costarica(strip_ws(F.coalesce(F.col("data_title"), F.lit(NO_TITLE))))
    ts, fecha, _ = apply_policy(F.nullif(F.col("fecha_raw"), F.lit("")), POLICIES["costarica"])
    r = (r.withColumn("titulo", titulo).withColumn("fecha_ts", ts).withColumn("fecha", fecha)
         .where(_or_unread(current_year_filter(F.col("fecha_ts"), run_year, strict=False)))     # F5
         .withColumn("url", F.when(_truthy(F.col("href")), absolute_url(F.lit(p.base_url), F.col("href")))))
    out = _const(_pos(r), p).select("url", "titulo", "fecha", "fecha_ts", "pais", "institucion", "source_id",
                                    "source_rank", *PAGE_KEYS[1:], "page_id", "item_pos", F.col("page_error").alias("fatal"))
    return _deduped(out) if dedupe else out


def feed_alerts(items: DataFrame, source_id: str) -> DataFrame:
    """P1 for the feed sources: dated feed items (with ``categoria, categoria_rank, page_id``) in the
    alert columns."""
    p = PROFILES[source_id]
    pdf = F.col("pdf") if "pdf" in items.columns else F.lit(None).cast("string")
    fatal = F.col("fatal") if "fatal" in items.columns else F.lit(None).cast("string")
    return _const(items, p).select("url", pdf.alias("pdf"), "titulo", "fecha", "fecha_ts", "pais", "institucion", "source_id", "source_rank",
                                   *PAGE_KEYS[1:], "page_id", F.col("item_pos").cast("bigint").alias("item_pos"), fatal.alias("fatal"))


def detail_fields(rows: DataFrame, url_col: str = "url") -> DataFrame:
    """Fields of a detail page: first h3 / ul under the entry, first .pdf link (absolute).
    The element matched on either attribute gives its href when it has one (else its src)."""
    p = PROFILES["peru"]
    r = _records(rows, p, keep=(url_col,)).where(F.col("page_error").isNull())
    link = F.when(F.col("pdf_href").isNotNull(), F.col("pdf_href")).otherwise(F.col("pdf_src"))
    return r.select(
        "page_id", url_col,
        F.when(F.col("motivo__found"), F.col("motivo")).otherwise(F.lit(NO_DETAIL)).alias("motivo"),
        F.when(F.col("producto__found"), F.col("producto")).alias("producto"),
        F.when(F.col("pdf_href__found"), absolute_url(F.col(url_col), link)).alias("pdf"),
    )


def feed_with_detail(items: DataFrame, details: DataFrame) -> DataFrame:
    """J2 + T1: each feed item with its detail page (left join on the link); an item without a
    readable detail page is fatal for the source in the reference (ours: flagged)."""
    d = details.select(F.col("url").alias("_durl"), "motivo", "producto", "pdf")
    out = items.join(d, items["url"] == d["_durl"], "left")
    fatal = (F.when(F.col("_durl").isNull(), F.lit("detail page missing"))
             .when(F.col("pdf").isNull(), F.lit("no pdf link on detail page")))
    return (out.withColumn("fatal", fatal)
            .withColumn("titulo", composite_title("titulo", "motivo", "producto")).drop("_durl"))
