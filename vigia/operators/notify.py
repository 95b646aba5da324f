"""Flag, link choice, message text, outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_escape

# Flag per country and the default.
FLAGS = {
    "Perú": "🇵🇪",
    "Chile": "🇨🇱",
    "Brasil": "🇧🇷",
    "Colombia": "🇨🇴",
    "México": "🇲🇽",
    "Argentina": "🇦🇷",
    "Bolivia": "🇧🇴",
    "Costa Rica": "🇨🇷",
}
DEFAULT_FLAG = "🌎"


def flag(pais) -> Column:
    """Map lookup with a default (a literal map, no join)."""
    m = F.create_map(*[x for k, v in FLAGS.items() for x in (F.lit(k), F.lit(v))])
    p = F.col(pais) if isinstance(pais, str) else pais
    return F.coalesce(F.try_element_at(m, p), F.lit(DEFAULT_FLAG))


def link_text(url="url", pdf="pdf") -> Column:
    """Web link if there is one, else the document, else ''."""
    u = F.col(url) if isinstance(url, str) else url
    d = F.col(pdf) if isinstance(pdf, str) else pdf
    return (F.when(F.coalesce(u, F.lit("")) != "", F.concat(F.lit("🔗 "), u))
            .when(F.coalesce(d, F.lit("")) != "", F.concat(F.lit("📥 "), d))
            .otherwise(F.lit("")))


def message(df: DataFrame) -> Column:
    """Five-line template; only institution and summary are escaped."""
    pdf = F.col("pdf") if "pdf" in df.columns else F.lit(None).cast("string")
    return F.concat(
        flag("pais"), F.lit(" <b>NUEVA ALERTA - "), F.coalesce(F.col("pais"), F.lit("None")), F.lit("</b>\n"),
        F.lit("🏛 <b>Institución:</b> "), html_escape(F.coalesce(F.col("institucion"), F.lit("None"))), F.lit("\n"),
        F.lit("📅 <b>Fecha:</b> "), F.coalesce(F.col("fecha"), F.lit("None")), F.lit("\n\n"),
        F.lit("⚠️ <b>"), html_escape(F.coalesce(F.col("resumen"), F.lit("None"))), F.lit("</b>\n\n"),
        link_text("url", pdf),
    )


def outbox(news: DataFrame, batch_id: str | int = 0, silent: bool = False) -> DataFrame:
    """K2: one message per new alert; silent mode sends nothing (history is still stored)."""
    out = news.select("url", message(news).alias("message"), F.lit(str(batch_id)).alias("batch_id"))
    return out.where(F.lit(False)) if silent else out
