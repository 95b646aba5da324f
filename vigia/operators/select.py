"""Selectors over shredded rows.

A selector is a comma list of descendant chains; a chain step is ``tag``, ``.class`` (any number),
``[attr]`` / ``[attr=v]`` / ``[attr$=v]`` / ``[attr^=v]`` / ``[attr*=v]``; a step given as
``tag|class value`` matches the whole class attribute (``find_all(tag, class_='a b')``).
Attribute tests apply to the last step only (no reference selector tests an ancestor's attribute).

Chains are stored as data — ``array<struct<tag, classes, cls>>`` — so one Column expression
matches literal selectors and selectors that come from a rules table alike: the last step must
match the element, the earlier steps must be a subsequence of its ancestors (greedy from the
end, one ``aggregate`` over the path, no self join).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_ws

STEP = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("cls", T.StringType()),
])
CHAIN = T.ArrayType(STEP)

_STEP_RE = re.compile(r"^(?P<tag>[A-Za-z][A-Za-z0-9\-]*|\*)?(?P<classes>(?:\.[\w\-]+)*)(?P<attrs>(?:\[[^\]]+\])*)$")
_ATTR_RE = re.compile(r"""\[\s*([\w\-:]+)\s*(?:([$^*]?=)\s*["']?([^"'\]]*)["']?)?\s*\]""")


@dataclass(frozen=True)
class Chain:
    steps: tuple[tuple[str | None, tuple[str, ...], str | None], ...]
    attrs: tuple[tuple[str, str | None, str | None], ...] = ()   # tests on the last step


def parse_selector(sel: str) -> list[Chain]:
    """Tokenise a selector group into chains (small helper; the matching is Spark's)."""
    chains = []
    for alt in sel.split(","):
        alt = alt.strip()
        if not alt:
            continue
        steps, attrs = [], ()
        toks = alt.split()
        for n, tok in enumerate(toks):
            if "|" in tok:                       # tag|whole class attribute (spaces as '+')
                tag, cls = tok.split("|", 1)
                steps.append((tag or None, (), cls.replace("+", " ")))
                continue
            m = _STEP_RE.match(tok)
            if not m:
                raise ValueError(f"unsupported selector step {tok!r}")
            tag = m.group("tag")
            classes = tuple(c for c in m.group("classes").split(".") if c)
            attrs = tuple((a, op, v) for a, op, v in _ATTR_RE.findall(m.group("attrs") or ""))
            attrs = tuple((a, op or None, v if op else None) for a, op, v in attrs)
            if attrs and n < len(toks) - 1:
                raise ValueError(f"attribute test on an ancestor step {tok!r}")
            steps.append((None if tag in (None, "*") else tag.lower(), classes, None))
        chains.append(Chain(tuple(steps), attrs))
    return chains


def chain_literal(chain: Chain) -> Column:
    return F.array(*[
        F.struct(
            F.lit(t).cast("string").alias("tag"),
            F.array(*[F.lit(c) for c in cl]).cast("array<string>").alias("classes"),
            F.lit(cls).cast("string").alias("cls"),
        )
        for t, cl, cls in chain.steps
    ]).cast(CHAIN)


def step_match(step: Column, e: Column) -> Column:
    return (
        (step["tag"].isNull() | (step["tag"] == e["tag"]))
        & F.forall(F.coalesce(step["classes"], F.array().cast("array<string>")), lambda c: F.array_contains(e["classes"], c))
        & (step["cls"].isNull() | (step["cls"] == e["cls"]))
    )


def _at(arr: Column, i: Column) -> Column:
    # safe positional access: never index 0 (an error even in try_element_at), null past the end.
    # Guards in And/when do not protect an index once Catalyst hoists a common subexpression.
    return F.try_element_at(arr, F.greatest(i, F.lit(1)))




def _let(value: Column, fn) -> Column:
    """Bind ``value`` once (it is the argument of a one-element transform) and use it in ``fn``."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _first_after(matches: Column, f: Column) -> Column:
    """First 1-based position after ``f`` whose flag is true, else null."""
    n = F.size(matches)
    pos = F.array_position(F.slice(matches, f + 1, F.greatest(n - f, F.lit(0))), F.lit(True))
    return F.when(pos > 0, f + pos)


def _step_flags(path: Column, step) -> Column:
    """Flags of one step over the path; ``step`` is a Column (rules data) or a literal tuple."""
    if isinstance(step, tuple):
        return F.transform(path, lambda e: F.coalesce(literal_step_match(step, e), F.lit(False)))
    return F.transform(path, lambda e: F.coalesce(step_match(step, e), F.lit(False)))


def literal_step_match(step: tuple, e: Column) -> Column:
    """step_match for a step known when the plan is built: no inner lambda over classes."""
    tag, classes, cls = step
    cond = F.lit(True)
    if tag:
        cond = cond & (e["tag"] == tag)
    for c in classes:
        cond = cond & F.array_contains(e["classes"], F.lit(c))
    if cls is not None:
        cond = cond & (e["cls"] == cls)
    return cond


def _finish(path: Column, last_step: Column, f: Column) -> Column:
    # the element at i matches when the last step matches it and every leading step matched
    # at or before f < i (greedy earliest matches decide a subsequence exactly)
    return _let(f, lambda fv: F.transform(_step_flags(path, last_step),
                                          lambda m, i0: m & fv.isNotNull() & (i0 + 1 > fv)))


def chain_flags(path: Column, chain: Column) -> Column:
    """array<boolean> over ``path``: does ``chain`` (a column of steps) match each position?

    Leading steps are placed greedily: f_j = first position after f_(j-1) matching step j (an
    integer ``aggregate`` over the step indexes), then the last step is tested below f.
    O(steps × depth) per row; one-step chains (the common case) take a lazy fast path."""
    k = F.size(chain)
    f = F.aggregate(
        F.sequence(F.lit(1), F.greatest(k - 1, F.lit(1))), F.lit(0),
        lambda fv, j: F.when(j < k, _first_after(_step_flags(path, _at(chain, j)), fv).cast("int")).otherwise(fv))
    general = _finish(path, _at(chain, k), f)
    return F.when(k == 1, _step_flags(path, _at(chain, F.lit(1)))).otherwise(general)


def chain_flags_lit(path: Column, chain: Chain) -> Column:
    """Same as :func:`chain_flags` for a chain known when the plan is built (steps unrolled)."""
    steps = list(chain.steps)
    if len(steps) == 1:
        return _step_flags(path, steps[0])
    f = F.lit(0)
    def advance(st):
        return lambda fv: _first_after(_step_flags(path, st), fv)

    for st in steps[:-1]:
        f = _let(f, advance(st))
    return _finish(path, steps[-1], f)


def _chain_from_step_flags(step_flags: list[Column]) -> Column:
    """Chain flags from per-step flag arrays (already computed over the same path)."""
    if len(step_flags) == 1:
        return step_flags[0]

    def advance(col):
        return lambda fv: _first_after(col, fv)

    f = F.lit(0)
    for col in step_flags[:-1]:
        f = _let(f, advance(col))
    last = step_flags[-1]
    return _let(f, lambda fv: F.transform(last, lambda m, i0: m & fv.isNotNull() & (i0 + 1 > fv)))


def _any_flags(flag_arrays: list[Column]) -> Column:
    if len(flag_arrays) == 1:
        return flag_arrays[0]
    return F.zip_with(flag_arrays[0], _any_flags(flag_arrays[1:]), lambda a, b: a | b)


def attr_test(attrs: Column, tests) -> Column:
    cond = F.lit(True)
    for name, op, val in tests:
        v = F.try_element_at(attrs, F.lit(name))
        if op is None:
            cond = cond & v.isNotNull()
        elif op == "=":
            cond = cond & (v == val)
        elif op == "$=":
            cond = cond & v.endswith(val)
        elif op == "^=":
            cond = cond & v.startswith(val)
        else:
            cond = cond & v.contains(val)
    return F.coalesce(cond, F.lit(False))


def selector_flags(selector: str, path: Column) -> Column:
    """Per-position flags for a literal selector (any alternative; attribute tests excluded)."""
    return _any_flags([chain_flags_lit(path, ch) for ch in parse_selector(selector)])


def self_match(selector: str, path: str = "path", attrs: str = "attrs", kind: str = "kind") -> Column:
    """An element row matches ``selector`` itself (any alternative, attribute tests included)."""
    p = F.col(path)
    cond = F.lit(False)
    for ch in parse_selector(selector):
        last = F.coalesce(F.try_element_at(chain_flags_lit(p, ch), F.lit(-1)), F.lit(False))
        cond = cond | (last & attr_test(F.col(attrs), ch.attrs))
    return (F.col(kind) == "el") & cond


def true_positions(flags: Column) -> Column:
    """1-based positions of the true entries of a boolean array."""
    seq = F.sequence(F.lit(1), F.greatest(F.size(flags), F.lit(1)))
    return F.filter(F.zip_with(seq, flags, lambda i, f: F.when(f, i)), lambda x: x.isNotNull())


# --------------------------------------------------------------------------------------------
# Record extraction: one row per container element (card, table row) or per document.
# --------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """A value taken from the first element (document order) inside the container matching
    ``selector``. ``value``: 'text_a' (strip runs, join ''), 'text_b' (join runs, strip ends),
    'text_c' (strip runs, drop empties, join ' '), or 'attr:<name>'. ``parent``: take the value
    of the matched element's parent instead (text of the node holding an icon)."""
    selector: str
    value: str = "text_b"
    parent: bool = False


@dataclass
class RecordSpec:
    container: str | None                 # None: the whole document is one record
    fields: dict[str, Field] = field(default_factory=dict)
    cells_tag: str | None = None          # also collect these descendants in order (table cells)
    first_desc_attr: tuple[str, str] = ("a", "href")


def record_texts(spec: RecordSpec) -> list[Column]:
    """Aggregates of an element's runs (``_raw`` as read, ``_str`` stripped, null where empty), in the
    text modes something reads (each ordered concat sorts its group)."""
    modes = {f.value for f in spec.fields.values() if f.value.startswith("text_")} | ({"text_a"} if spec.cells_tag else set())
    mode_expr = {
        "text_a": F.coalesce(F.expr("listagg(_str, '') within group (order by seq)"), F.lit("")),
        "text_b": strip_ws(F.coalesce(F.expr("listagg(_raw, '') within group (order by seq)"), F.lit(""))),
        "text_c": F.coalesce(F.expr("listagg(_str, ' ') within group (order by seq)"), F.lit("")),
    }
    return [(mode_expr[m] if m in modes else F.lit("")).alias(m) for m in ("text_a", "text_b", "text_c")]


def grouped_records(per_elem: DataFrame, id_col: str, spec: RecordSpec, keep: list[str], *more: Column) -> DataFrame:
    """One row per container from one row per (container, element): each field's first match, the
    container's attributes, its cells, and ``more`` aggregates."""
    fields = spec.fields

    def value_of(f: Field) -> Column:
        if f.value.startswith("attr:"):
            return F.try_element_at(F.col("attrs"), F.lit(f.value[5:]))
        return F.col(f.value)

    aggs = [F.min_by(F.when(F.col("elem_id") == F.col("card_id"), F.col("attrs")),
                     F.when(F.col("elem_id") == F.col("card_id"), F.col("elem_id"))).alias("card_attrs")]
    for k in [k for k, f in fields.items() if not f.parent]:
        hit = F.coalesce(F.array_contains(F.col("self_f"), F.lit(k)), F.lit(False)) & (F.col("elem_id") != F.col("card_id"))
        aggs.append(F.min_by(F.when(hit, value_of(fields[k])), F.when(hit, F.col("elem_id"))).alias(k))
        aggs.append(F.max(hit).alias(f"{k}__found"))
    for k in [k for k, f in fields.items() if f.parent]:
        order = F.array_min(F.transform(F.filter("par_marks", lambda m: m["f"] == k), lambda m: m["o"]))
        aggs.append(F.min_by(F.when(order.isNotNull(), value_of(fields[k])), order).alias(k))
        aggs.append(F.max(order.isNotNull()).alias(f"{k}__found"))
    if spec.cells_tag:
        cell = F.when((F.col("elem_tag") == spec.cells_tag) & (F.col("elem_id") != F.col("card_id")),
                      F.struct(F.col("elem_id").alias("id"), F.col("text_a"), F.col("first_desc_attr").alias("link")))
        aggs.append(F.array_sort(F.collect_list(cell)).alias("cells"))
    return per_elem.groupBy(id_col, *keep, "card_id").agg(*aggs, *more)


def extract_records(rows: DataFrame, id_col: str, spec: RecordSpec, keep: list[str] | None = None) -> DataFrame:
    """Shredded rows → one row per container with its fields.

    Plan: a narrow per-row stage finds the container positions and emits one contribution per
    (container, element at or below it); a grouped aggregation builds element texts/attributes;
    a second grouped aggregation picks each field's first match. Only rows inside containers
    travel through the shuffle, and both groups are bounded by one container's markup.
    """
    keep = keep or []
    p = F.col("path")
    n = F.size(p)
    is_el = F.col("kind") == "el"

    fields = spec.fields
    self_f = [k for k, f in fields.items() if not f.parent]
    parent_f = [k for k, f in fields.items() if f.parent]

    base = rows.where(F.col("kind") != "doc")
    # one flag array per distinct step over all selectors (container, fields, parent prefixes),
    # materialised once per row; every chain is then built from these arrays
    steps: list[tuple] = []

    def step_col(st):
        if st not in steps:
            steps.append(st)
        return F.col(f"_st{steps.index(st)}")

    def flags_of(chain: Chain) -> Column:
        cols = [step_col(st) for st in chain.steps]
        return _chain_from_step_flags(cols)

    def selector_of(sel: str) -> Column:
        return _any_flags([flags_of(ch) for ch in parse_selector(sel)])

    sels = list(dict.fromkeys(f.selector for f in fields.values()))
    sel_flags = {sel: selector_of(sel) for sel in sels}
    cont_flags = selector_of(spec.container) if spec.container is not None else None
    prefix_need = []
    for k in parent_f:
        for ch in parse_selector(fields[k].selector):
            if len(ch.steps) < 2:        # the parent of a one-step match can be any element
                prefix_need.append(None)
            else:
                # the parent of a match sits at or below the element where the chain without its
                # last step first matches (greedy earliest), so only those positions can hold it
                prefix_need.append(flags_of(Chain(ch.steps[:-1])))
    base = base.select("*", *[_step_flags(p, st).alias(f"_st{x}") for x, st in enumerate(steps)])
    base = base.select("*", *[sel_flags[sel].alias(f"_ff{x}") for x, sel in enumerate(sels)])
    ff = {k: F.col(f"_ff{sels.index(f.selector)}") for k, f in fields.items()}

    def self_hit(k):
        chains = parse_selector(fields[k].selector)
        if any(ch.attrs for ch in chains):
            cond = F.lit(False)
            for ch in chains:
                last = F.coalesce(F.try_element_at(flags_of(ch), F.lit(-1)), F.lit(False))
                cond = cond | (last & attr_test(F.col("attrs"), ch.attrs))
            return is_el & cond
        return is_el & F.coalesce(F.try_element_at(ff[k], F.lit(-1)), F.lit(False))

    def fields_matching(names):
        arr = [F.when(self_hit(k), F.lit(k)) for k in names]
        return F.filter(F.array(*arr), lambda x: x.isNotNull()) if arr else F.array().cast("array<string>")

    if spec.container is None:
        base = base.withColumn("_card_pos", F.lit(1)).withColumn("card_id", F.lit(-1))
    else:
        base = base.withColumn("_card_pos", F.explode(true_positions(cont_flags)))
        base = base.withColumn("card_id", _at(p, F.col("_card_pos"))["id"])

    base = base.withColumn("_self_f", F.when(is_el, fields_matching(self_f)))
    base = base.withColumn("_par_f", F.when(is_el, fields_matching(parent_f)))

    # a row contributes only to the elements something reads: the container (attributes),
    # elements a field selector matches, table cells, parents of parent-mode matches
    need = [F.col(f"_ff{x}") for x in range(len(sels))]
    for pre in prefix_need:
        if pre is None:
            need.append(F.transform(p, lambda e: F.lit(True)))
        else:
            need.append(_let(F.array_position(pre, F.lit(True)),
                             lambda f0: F.transform(p, lambda e, i0: (f0 > 0) & (i0 + 1 >= f0))))
    if spec.cells_tag:
        need.append(F.transform(p, lambda e: F.coalesce(e["tag"] == spec.cells_tag, F.lit(False))))
    need_arr = _any_flags(need)
    entries = F.zip_with(p, need_arr, lambda e, nd: F.struct(e["id"].alias("elem_id"), e["tag"].alias("elem_tag"), nd.alias("nd")))
    c = base.select(
        id_col, *keep, "card_id", "_card_pos", "seq", "kind", "tag", "attrs", "text", "cdata_id", "node_id", "_self_f", "_par_f",
        F.size(p).alias("_n"), F.posexplode(entries).alias("_pos0", "c"),
    )
    pos = F.col("_pos0") + 1
    c = c.where((pos >= F.col("_card_pos")) & (F.col("c.nd") | (pos == F.col("_card_pos"))))
    c = c.select("*", F.col("c.elem_id").alias("elem_id"), F.col("c.elem_tag").alias("elem_tag"),
                 (is_el & (pos == F.col("_n"))).alias("is_self"), (is_el & (pos == F.col("_n") - 1)).alias("is_parent")).drop("c")

    visible = (F.col("kind") == "text") & (F.col("cdata_id").isNull() | (F.col("cdata_id") == F.col("elem_id")))
    stripped = F.nullif(strip_ws(F.col("text")), F.lit(""))
    c = c.withColumn("_raw", F.when(visible, F.col("text"))).withColumn("_str", F.when(visible, stripped))
    # per element: only what a field, the container or the cells read
    keep_attrs = F.col("is_self") & ((F.size(F.coalesce("_self_f", F.array())) > 0) | (F.col("elem_id") == F.col("card_id")))
    elem_aggs = [
        F.first("elem_tag").alias("elem_tag"),
        *record_texts(spec),
        F.min_by(F.when(keep_attrs, F.col("attrs")), F.when(keep_attrs, F.col("seq"))).alias("attrs"),
    ]
    if self_f:
        elem_aggs.append(F.max(F.when(F.col("is_self"), F.col("_self_f"))).alias("self_f"))
    if parent_f:
        elem_aggs.append(F.flatten(F.collect_list(F.when(F.col("is_parent") & (F.size("_par_f") > 0), F.transform(
            "_par_f", lambda f: F.struct(f.alias("f"), F.col("node_id").alias("o")))))).alias("par_marks"))
    if spec.cells_tag:
        desc = ~F.col("is_self") & (F.col("kind") == "el") & (F.col("tag") == spec.first_desc_attr[0])
        elem_aggs.append(F.min_by(F.when(desc, F.try_element_at(F.col("attrs"), F.lit(spec.first_desc_attr[1]))),
                                  F.when(desc, F.col("seq"))).alias("first_desc_attr"))
    # one exchange on (page, container) serves both groupings (element, then container)
    per_elem = c.repartition(id_col, "card_id").groupBy(id_col, *keep, "card_id", "elem_id").agg(*elem_aggs)

    return grouped_records(per_elem, id_col, spec, keep)


# --------------------------------------------------------------------------------------------
# Content by rule lists (A7): remove, scope, select — rules given per row as data.
# --------------------------------------------------------------------------------------------

def html_content(rows: DataFrame, id_col: str, keep: list[str] | None = None,
                 title_selector: str | None = None) -> DataFrame:
    """Text of a page under its rules (columns ``container`` array<struct> chain or null,
    ``selectors`` / ``remove`` array<chain>), one row per page, null when nothing is found.

    * removed: a row under any element matched by a remove chain is dropped (F11);
    * scope: the first remaining element matching the container, else the document (F7);
    * fragments: for each selector in order, each matched element inside the scope in document
      order, its runs stripped and joined by ' ' (mode c); nested matches repeat text (A7);
    * the joined text is whitespace-collapsed, '' → null (T6, T7);
    * ``title_selector``: also the stripped text of the first element matching it (``titulo``),
      from the same pass (same window, same aggregation).
    """
    from ..functions.text import collapse_ws, empty_to_null
    from pyspark.sql import Window

    keep = keep or []
    p = F.col("path")
    n = F.size(p)
    positions = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    is_el, is_text = F.col("kind") == "el", F.col("kind") == "text"

    # 1. narrow: removal, candidate scope/title elements, every selector match of a text run
    removed = F.exists(F.col("remove"), lambda ch: F.exists(chain_flags(p, ch), lambda x: x))
    r = rows.where(~F.coalesce(removed, F.lit(False)))
    r = r.withColumn("_fs", F.when(is_text, F.transform(F.col("selectors"), lambda ch: chain_flags(p, ch))))
    scope_cand = F.when(is_el & F.coalesce(F.try_element_at(chain_flags(p, F.col("container")), F.lit(-1)), F.lit(False)),
                        F.col("node_id"))
    frags = F.flatten(F.transform(
        F.col("_fs"),
        lambda fl, r0: F.transform(
            true_positions(fl),
            lambda i: F.struct((r0 + 1).alias("rule_no"), i.alias("pos"), _at(p, i)["id"].alias("elem_id")),
        ),
    ))
    title_cand = F.lit(None).cast("int")
    under_title = F.lit(False)
    if title_selector:
        title_cand = F.when(self_match(title_selector), F.col("node_id"))
        under_title = is_text & F.exists(selector_flags(title_selector, p), lambda x: x)
    r = r.select(id_col, *keep, "seq", "kind", "text", "cdata_id", "container",
                 F.transform(p, lambda e: e["id"]).alias("_ids"),
                 scope_cand.alias("_scope_cand"), title_cand.alias("_title_cand"),
                 F.when(is_text, frags).alias("_frags"), under_title.alias("_under_title"))
    # only rows that can matter travel through the shuffle (one 'doc' row keeps every page)
    r = r.where((F.col("kind") == "doc") | F.col("_scope_cand").isNotNull() | F.col("_title_cand").isNotNull()
                | (F.size(F.coalesce("_frags", F.array())) > 0) | F.col("_under_title"))

    # 2. per page: first container and first title element (one exchange on the page id,
    #    reused by the aggregation below)
    w = Window.partitionBy(id_col)
    r = (r.withColumn("scope_id", F.min("_scope_cand").over(w))
          .withColumn("_title_id", F.min("_title_cand").over(w))
          .withColumn("_has_container", F.max(F.col("container").isNotNull()).over(w)))
    scope_pos = F.array_position(F.col("_ids"), F.col("scope_id"))
    in_scope = F.filter("_frags", lambda f: ~F.coalesce(F.col("_has_container"), F.lit(False))
                        | ((scope_pos > 0) & (f["pos"] > scope_pos)))
    in_title = (is_text & F.array_contains(F.col("_ids"), F.col("_title_id"))
                & (F.col("cdata_id").isNull() | (F.col("cdata_id") == F.col("_title_id"))))
    r = r.withColumn("_title_run", F.when(in_title, F.col("text")))
    t = r.select("*", F.posexplode_outer(in_scope).alias("_fpos", "_frag"))
    visible = F.col("cdata_id").isNull() | (F.col("cdata_id") == F.col("_frag.elem_id"))
    piece = F.when(F.col("_frag").isNotNull() & visible, F.nullif(strip_ws(F.col("text")), F.lit("")))
    # a text row exploded into several fragments counts once for the title
    title_run = F.when(F.coalesce(F.col("_fpos"), F.lit(0)) == 0, F.col("_title_run"))
    t = t.select(id_col, *keep, "seq", piece.alias("_piece"), F.col("_frag.rule_no").alias("_rule_no"),
                 F.col("_frag.elem_id").alias("_elem_id"), title_run.alias("_title_run"))
    aggs = [F.expr("listagg(_piece, ' ') within group (order by _rule_no, _elem_id, seq)").alias("_joined")]
    if title_selector:
        aggs.append(F.expr("listagg(_title_run, '') within group (order by seq)").alias("_title"))
    out = t.groupBy(id_col, *keep).agg(*aggs)
    cols = [id_col, *keep, empty_to_null(collapse_ws(F.col("_joined"))).alias("content")]
    if title_selector:
        cols.append(strip_ws(F.coalesce(F.col("_title"), F.lit(""))).alias("titulo"))
    return out.select(*cols)
