"""Date scalars: parse policies per source as data, applied with try_to_timestamp.

Every rule collapses internal whitespace first (strptime lets repeated spaces match one format
space, Spark's parser does not) and uses ``try_to_timestamp`` so a bad value is null, never an
error under ANSI mode. Results are rendered with ``date_format`` in the session zone (UTC).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS_CLASS


@dataclass(frozen=True)
class DatePolicy:
    formats: tuple[str, ...]     # Spark patterns tried in order
    out: str                     # rendering of a parsed value
    on_bad: str                  # 'raw' keep input, 'drop' row out, 'fatal' group fails, 'sentinel'
    missing: str | None = None   # value when the input is absent (None: row is dropped)


# Formats, renderings and sentinels of the eight sources.
FEED_FORMATS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm z")
SHORT_YEAR = r"^(\d{1,2}\s+[A-Za-z]{3}\s+)(\d{2})(\s.*)$"
POLICIES = {
    "peru": DatePolicy(FEED_FORMATS, "dd-MM-yyyy HH:mm:ss", "sentinel", "Sin Fecha"),
    "chile": DatePolicy(FEED_FORMATS, "dd-MM-yyyy HH:mm:ss", "sentinel", "Sin Fecha"),
    "brasil": DatePolicy(("d/M/yyyy H:m",), "dd-MM-yyyy HH:mm", "raw"),
    "colombia": DatePolicy(("yyyy-M-d",), "dd-MM-yyyy", "fatal"),
    "mexico": DatePolicy(("ddMMyyyy",), "dd-MM-yyyy", "raw", "Sin Fecha"),
    "argentina": DatePolicy(("yyyy-M-d H:m:s",), "dd-MM-yyyy HH:mm", "raw", "Sin fecha"),
    "bolivia": DatePolicy(("d/M/yyyy",), "dd-MM-yyyy", "drop"),
    "costarica": DatePolicy(("yyyy-M-d H:m:s",), "dd-MM-yyyy HH:mm", "raw", "Sin fecha"),
}
REPORT_FORMATS = ("d-M-yyyy",)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_ts(s, formats) -> Column:
    """First format that parses, else null."""
    v = F.regexp_replace(_c(s), WS_CLASS + "+", " ")
    return F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in formats])


def feed_ts(s) -> Column:
    """RFC 822 date, of two or four digits a year (00 to 68 are of this century, as the feed
    dialect has it), or an ISO 8601 date or time; without a zone it is UTC. The day name is dropped
    first (Spark cannot parse ``EEE``)."""
    body = F.trim(F.regexp_replace(_c(s), r"^\s*[A-Za-z]{2,9},\s*", ""))
    # the year of RFC 822 has two digits
    year = F.regexp_extract(body, SHORT_YEAR, 2)
    full = F.concat(F.regexp_extract(body, SHORT_YEAR, 1), F.when(year <= "68", F.lit("20")).otherwise(F.lit("19")), year, F.regexp_extract(body, SHORT_YEAR, 3))
    short = parse_ts(F.when(year != "", full), FEED_FORMATS)
    return F.coalesce(parse_ts(body, FEED_FORMATS), short, F.when(body.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}.*)?$"), F.try_to_timestamp(body)))


def apply_policy(raw, policy: DatePolicy, raw_fallback=None) -> tuple[Column, Column, Column]:
    """Return (fecha_ts, fecha, status) for a raw date column.

    status: 'ok', 'missing', 'bad' — the caller turns 'bad' into raw/drop/fatal per policy.
    ``raw_fallback`` is what 'raw' keeps (Brazil keeps the date part only).
    """
    raw = _c(raw)
    ts = feed_ts(raw) if policy.formats == FEED_FORMATS else parse_ts(raw, policy.formats)
    status = F.when(raw.isNull(), F.lit("missing")).when(ts.isNull(), F.lit("bad")).otherwise(F.lit("ok"))
    keep = raw if raw_fallback is None else _c(raw_fallback)
    bad_value = {"raw": keep, "sentinel": F.lit(policy.missing)}.get(policy.on_bad, F.lit(None).cast("string"))
    fecha = (
        F.when(raw.isNull(), F.lit(policy.missing))
        .when(ts.isNull(), bad_value)
        .otherwise(F.date_format(ts, policy.out))
    )
    return ts, fecha, status


def report_date(fecha, formats=REPORT_FORMATS) -> Column:
    """Token before the first space, day first → date (null when it does not parse)."""
    tok = F.substring_index(_c(fecha), " ", 1)
    return F.coalesce(*[F.to_date(F.try_to_timestamp(tok, F.lit(f))) for f in formats])


def current_year_filter(ts, run_year, strict: bool) -> Column:
    """F4 (strict: unparsed or other year out) / F5 (lenient: only a parsed other year out)."""
    ts = _c(ts)
    same = F.year(ts) == F.lit(run_year)
    return same if strict else (ts.isNull() | same)
