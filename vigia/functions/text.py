"""String scalars as Column expressions (whole texts, JVM side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, as one regex class that both
# Java regex (Spark) and RE2 (DuckDB oracle) read the same way. Spark's trim() only drops U+0020.
WS_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_WS_ENDS = rf"^{WS_CLASS}+|{WS_CLASS}+$"
_WS_RUN = rf"{WS_CLASS}+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(s) -> Column:
    """T5: Unicode whitespace off both ends (Python ``str.strip()``)."""
    return F.regexp_replace(_c(s), _WS_ENDS, "")


def collapse_ws(s) -> Column:
    """Every whitespace run becomes one space, ends stripped (``' '.join(s.split())``)."""
    return strip_ws(F.regexp_replace(_c(s), _WS_RUN, " "))


def empty_to_null(s) -> Column:
    """T7: '' becomes null."""
    return F.nullif(_c(s), F.lit(""))


def html_escape(s) -> Column:
    """The five markup characters, ``&`` first."""
    s = _c(s)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def capitalize(s) -> Column:
    """First character upper, the rest lower (``str.capitalize``; not ``initcap``)."""
    s = _c(s)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 2147483647)))


def first_8_digits(s) -> Column:
    """First run of eight digits, null when there is none."""
    return F.regexp_substr(_c(s), F.lit(r"[0-9]{8}"))


def clean_title_mexico(s) -> Column:
    """Cut at the first '.pdf'; when an 8-digit run exists in the title, delete every
    occurrence of it, strip '_' from both ends, then whitespace."""
    s = _c(s)
    cut = F.substring_index(s, ".pdf", 1)
    d = first_8_digits(s)
    cleaned = strip_ws(F.btrim(F.replace(cut, d, F.lit("")), F.lit("_")))
    return F.when(d.isNull(), cut).otherwise(cleaned)


# Fixed value: leading Spanish date as written in Costa Rica titles ("5 de marzo de 2025. ").
COSTA_RICA_DATE_PREFIX = r"^\d{1,2}\s+de\s+[a-zA-Záéíóú]+\s+(?:de\s+\d{4})?[.\-]?\s*"


def clean_title_costarica(s) -> Column:
    """T4: drop a leading date (any case), strip, capitalise."""
    s = _c(s)
    return capitalize(strip_ws(F.regexp_replace(s, "(?iU)" + COSTA_RICA_DATE_PREFIX, "")))


def composite_title(titulo, motivo, producto) -> Column:
    """Feed title with detail reason and products; no reason → plain title."""
    t, m, p = _c(titulo), _c(motivo), _c(producto)
    return (
        F.when((F.coalesce(m, F.lit("")) != "") & p.isNotNull(), F.concat(t, F.lit(" - "), m, F.lit(". Productos: "), p))
        .when(F.coalesce(m, F.lit("")) != "", F.concat(t, F.lit(" - "), m))
        .otherwise(t)
    )


def preview(s, n: int = 50) -> Column:
    """First n characters."""
    return F.left(_c(s), F.lit(n))


def token_before_space(s) -> Column:
    """The part before the first space."""
    return F.substring_index(_c(s), " ", 1)


def lead_words(s, n: int = 30) -> Column:
    """U2 default summariser: the first n words of the whole, whitespace-collapsed text.

    Words are maximal runs of characters outside :data:`WS_CLASS` (as in :func:`collapse_ws`), so
    the first n of them joined by one space equal the first n items of the collapsed text split
    on spaces — without building an array of every word of a 20,000-word document."""
    word = "[^" + WS_CLASS[1:]
    first = F.regexp_extract(_c(s), rf"^{WS_CLASS}*((?:{word}+{WS_CLASS}+){{0,{n - 1}}}{word}+)", 1)
    return collapse_ws(first)
