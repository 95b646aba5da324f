"""Relative link resolution as one Column expression (no UDF, no parse_url).

Follows the standard-library join used by the reference: a link with its own scheme is kept;
'//host/...' takes the base scheme; an empty path keeps the base path (and base query unless the
link has one); otherwise the path is merged with the base directory and dot segments removed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3986 appendix B split, with the scheme made optional for links.
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_HAS_QUERY = r"^[^#]*\?"
_HAS_FRAG = r"#"


def _part(s: Column, i: int) -> Column:
    return F.regexp_extract(s, _SPLIT, i)


def _remove_dots(segs: Column) -> Column:
    """Apply '..' (pop) and '.' (skip) over a segment array; trailing dot segment adds ''."""
    resolved = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    last = F.element_at(segs, -1)
    return F.when(last.isin(".", ".."), F.array_append(resolved, F.lit(""))).otherwise(resolved)


# Plain links need no resolution: with a host; from the root; below the base's directory. None holds
# white space, control characters, a dot segment, or an empty query or fragment.
_WITH_HOST = r"^https?://[^/?#\x00-\x20]+(?:/[^?#\x00-\x20]*)?(?:\?[^#\x00-\x20]+)?\z"
_FROM_ROOT = r"^/(?![/.])(?:(?!/\.)[^?#\x00-\x20])*\z"
_BELOW = r"^(?![/.])(?:(?!/[/.])[^?#:\x00-\x20])+\z"
_PLAIN_BASE = r"^https?://[^/?#\x00-\x20]+(?!.*/[/.])(?:/[^?#\x00-\x20]*)?\z"


def absolute_url(base, link) -> Column:
    """Resolve ``link`` against ``base``; null or empty link gives the base.

    Plain links are put together by two pattern tests; the rest is taken apart."""
    base = F.col(base) if isinstance(base, str) else base
    raw = F.col(link) if isinstance(link, str) else link
    origin = F.regexp_extract(base, r"^(https?://[^/]+)", 1)
    below = F.when(base.rlike(r"^https?://[^/]+/"), F.regexp_extract(base, r"^(.*/)[^/]*$", 1)).otherwise(F.concat(base, F.lit("/")))
    plain = base.rlike(_PLAIN_BASE)
    return (F.when(plain & raw.rlike(_WITH_HOST), raw)
            .when(plain & raw.rlike(_FROM_ROOT), F.concat(origin, raw))
            .when(plain & raw.rlike(_BELOW), F.concat(below, raw))
            .otherwise(_resolved(base, raw)))


def _resolved(base: Column, raw: Column) -> Column:
    """Any link against any base.

    The URL parts are extracted once and bound in a one-element ``transform`` so the
    resolution logic reads fields instead of repeating each regex (a small plan, no repeated
    evaluation)."""
    # the standard split drops leading control characters and spaces, and tabs and line breaks
    link = F.regexp_replace(F.regexp_replace(raw, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    parts = F.struct(
        base.alias("b"), raw.alias("l"),
        _part(base, 1).alias("b_scheme"), _part(base, 2).alias("b_net"), _part(base, 3).alias("b_path"),
        _part(base, 4).alias("b_query"),
        _part(link, 1).alias("l_scheme"), _part(link, 2).alias("l_net"), _part(link, 3).alias("l_path"),
        _part(link, 4).alias("l_query"), _part(link, 5).alias("l_frag"),
        F.regexp_like(link, F.lit(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//")).alias("l_has_net"),
    )
    return F.element_at(F.transform(F.array(parts), _resolve), 1)


def _resolve(u: Column) -> Column:
    b_scheme, b_path, b_query = u["b_scheme"], u["b_path"], u["b_query"]
    l_scheme, l_path, l_query, l_frag = u["l_scheme"], u["l_path"], u["l_query"], u["l_frag"]

    def render(net, path, query, frag) -> Column:
        p = F.when((net != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
        return F.concat(
            b_scheme, F.lit(":"),
            F.when(net != "", F.concat(F.lit("//"), net)).otherwise(F.lit("")),
            p,
            F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
            F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit("")),
        )

    # directory of the base path, then the link's segments; empties inside a relative merge drop
    base_dir = F.split(b_path, "/")
    base_dir = F.when(F.element_at(base_dir, -1) != "", F.slice(base_dir, 1, F.greatest(F.size(base_dir) - 1, F.lit(0)))).otherwise(base_dir)
    merged = F.concat(base_dir, F.split(l_path, "/"))
    n = F.size(merged)
    merged = F.when(
        n > 2,
        F.concat(F.slice(merged, 1, 1), F.filter(F.slice(merged, 2, F.greatest(n - 2, F.lit(1))), lambda x: x != ""), F.slice(merged, -1, 1)),
    ).otherwise(merged)
    segs = F.when(l_path.startswith("/"), F.split(l_path, "/")).otherwise(merged)
    joined = F.array_join(_remove_dots(segs), "/")
    new_path = F.when(joined == "", F.lit("/")).otherwise(joined)
    empty_path_q = F.when(l_query != "", l_query).otherwise(b_query)
    return (
        F.when(u["l"].isNull() | (u["l"] == ""), u["b"])
        .when((l_scheme != "") & (F.lower(l_scheme) != F.lower(b_scheme)), u["l"])
        .when(u["l_has_net"], render(u["l_net"], l_path, l_query, l_frag))
        .when(l_path == "", render(u["b_net"], b_path, empty_path_q, l_frag))
        .otherwise(render(u["b_net"], new_path, l_query, l_frag))
    )


def host_of(url) -> Column:
    """Network location of a URL ('' when there is none)."""
    u = F.col(url) if isinstance(url, str) else url
    return F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)", 1))
