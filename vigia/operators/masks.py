"""Selectors as step masks: chains are matched while the page is parsed, on the open-element stack.

Every step of every chain is one bit. An element carries one small integer: the bits of all chain
prefixes that end at it or above it (a chain is a subsequence of the path, so a bit, once set, holds
for everything below). With ``m`` the steps that an element itself can be, its new bits are

    ((above << 1) | first steps) & m

and the chains it completes are the last bits among them. ``m`` depends on tag and class alone and
is looked up, so an element costs a dictionary read and four integer operations, whatever the depth
of the page or the number of selectors. Only what a selector reads leaves the parser: no paths.

* :func:`page_records` gives the records of :func:`vigia.operators.select.extract_records`: one row
  per element that a field, the container or a cell reads and one per text run in it; texts and
  first matches are then built by the same grouped aggregations.
* :func:`page_content` gives the content of :func:`vigia.operators.select.html_content`: scope and
  removal are decided at the element, the runs of each fragment leave with (rule, element, place).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import collapse_ws, empty_to_null, strip_ws
from .select import RecordSpec, parse_selector
from .tree import TreeParser

Step = tuple[str | None, tuple[str, ...], str | None]


class StepMasks:
    """Bits for a list of chains; ``ends[c]`` is the bit an element has when it completes chain c."""

    def __init__(self, chains: list[list[Step]]):
        self.steps: list[Step] = []
        self.ends: list[int] = []
        self.first = 0
        for chain in chains:
            self.first |= 1 << len(self.steps)
            self.steps += chain
            self.ends.append(1 << (len(self.steps) - 1))
        self.known: dict[tuple[str, str], int] = {}

    def of(self, tag: str, cls: str) -> int:
        """The steps that an element of this tag and class attribute can be."""
        got = self.known.get((tag, cls))
        if got is None:
            own = cls.split()
            whole, got = " ".join(own), 0
            for bit, (t, classes, exact) in enumerate(self.steps):
                if (t is None or t == tag) and all(c in own for c in classes) and (exact is None or exact == whole):
                    got |= 1 << bit
            if len(self.known) < 10_000:  # pages may hold any number of class attributes
                self.known[tag, cls] = got
        return got

    def enter(self, above: int, tag: str, cls: str) -> int:
        """The new bits of an element under one with the bits ``above``."""
        return ((above << 1) | self.first) & self.of(tag, cls)


def _holds(attrs: dict[str, str], tests: tuple) -> bool:
    for name, op, want in tests:
        v = attrs.get(name)
        if v is None or not (op is None or (op == "=" and v == want) or (op == "$=" and v.endswith(want))
                             or (op == "^=" and v.startswith(want)) or (op == "*=" and want in v)):
            return False
    return True


# --------------------------------------------------------------------------------------------
# Records
# --------------------------------------------------------------------------------------------

@dataclass
class RecordProgram:
    """A record specification as data: chains of the container and of each field."""
    container: list[list[Step]] | None
    fields: list[tuple[str, bool, bool, list[tuple[list[Step], tuple]]]]  # name, on the parent, a text, chains with tests
    cells_tag: str | None
    link: tuple[str, str]


def record_program(spec: RecordSpec) -> RecordProgram:
    steps = lambda sel: [list(c.steps) for c in parse_selector(sel)]
    return RecordProgram(None if spec.container is None else steps(spec.container),
                         [(k, f.parent, f.value.startswith("text_"), [(list(c.steps), c.attrs) for c in parse_selector(f.selector)]) for k, f in spec.fields.items()],
                         spec.cells_tag, spec.first_desc_attr)


#: What is read of an element: its runs in order, the fields that match it or a child of it.
ELEMENT = T.StructType([
    T.StructField("elem_id", T.IntegerType()), T.StructField("elem_tag", T.StringType()), T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("self_f", T.ArrayType(T.StringType())),
    T.StructField("par_marks", T.ArrayType(T.StructType([T.StructField("f", T.StringType()), T.StructField("o", T.IntegerType())]))),
    T.StructField("first_desc_attr", T.StringType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField("seq", T.IntegerType()), T.StructField("text", T.StringType())]))),
])
PART_FIELDS = [T.StructField("card_id", T.IntegerType()), T.StructField("elems", T.ArrayType(ELEMENT)), T.StructField("page_error", T.StringType())]
ERROR_CARD = -2  # the record of a page the parser gave up on


def record_reader(program: RecordProgram) -> Callable[[str], list[tuple]]:
    """html → one row a record (the values of ``PART_FIELDS``)."""
    chains: list[list[Step]] = list(program.container or [])
    masks_of: list[tuple[int, str, bool, bool, tuple]] = []
    first_field = len(chains)
    for name, parent, is_text, alternatives in program.fields:
        for steps, tests in alternatives:
            masks_of.append((len(chains), name, parent, is_text, tests))
            chains.append(steps)
    masks = StepMasks(chains)
    is_card = sum(masks.ends[:first_field])
    tests_of = [(masks.ends[c], name, parent, tests) for c, name, parent, _, tests in masks_of]
    is_read = sum(masks.ends[c] for c, _, parent, _, _ in masks_of if not parent)
    is_text = sum(masks.ends[c] for c, _, parent, text, _ in masks_of if not parent and text)
    whole, cells, link_tag, link_attr = program.container is None, program.cells_tag, *program.link
    known, first = masks.known, masks.first

    class Reader(TreeParser):
        def __init__(self):
            super().__init__()
            self.above = [0]  # bits of the open elements
            self.cards: list[tuple[int, ...]] = [(-1,) if whole else ()]  # records an open element lies in
            self.paths: list[tuple[int, ...]] = [()]  # open elements in a record, itself last
            self.info: dict[int, tuple] = {}  # id → tag, attributes, records
            self.read_of: dict[int, list[str]] = {}  # elements a field matches
            self.marks: dict[int, list[tuple[str, int]]] = {}  # parents a field reads
            self.needed: set[int] = set()  # elements whose text is read
            self.links: dict[int, str | None] = {}  # first link inside a cell
            self.runs: list[tuple[int, str, int | None, tuple[int, ...]]] = []

        def element(self, nid, tag, attrs, stays_open):
            above, cards = self.above[-1], self.cards[-1]
            own = known.get((tag, cls := attrs.get("class", "")))
            new = ((above << 1) | first) & (masks.of(tag, cls) if own is None else own)  # masks.enter
            if new & is_card:
                cards = (*cards, nid)
            if cards:
                kept = None
                if new & is_read or tag == cells or cards[-1] == nid or (whole and nid == 0):
                    kept = attrs
                    if new & is_text or tag == cells:
                        self.needed.add(nid)
                self.info[nid] = (tag, kept, cards)
                if new:
                    for bit, name, parent, tests in tests_of:
                        if new & bit and _holds(attrs, tests):
                            if not parent:
                                if name not in (names := self.read_of.setdefault(nid, [])):
                                    names.append(name)
                            elif self.stack and self.cards[-1]:
                                up = self.stack[-1][0]
                                self.needed.add(up)
                                self.marks.setdefault(up, []).append((name, nid))
                if cells and tag == link_tag:
                    for up, t in self.stack:
                        if t == cells and up in self.info and up not in self.links:
                            self.links[up] = attrs.get(link_attr)
            if stays_open:
                self.above.append(above | new)
                self.cards.append(cards)
                self.paths.append((*self.paths[-1], nid) if cards else ())

        def cut(self, depth):
            del self.above[depth + 1:], self.cards[depth + 1:], self.paths[depth + 1:]

        def text(self, parent, data, cdata_id):
            if self.cards[-1]:
                self.runs.append((self.seq, data, cdata_id, self.paths[-1]))

        def parts(self) -> list[tuple]:
            needed = self.needed
            said: dict[int, list[tuple[int, str]]] = {nid: [] for nid in needed}
            for seq, data, cdata_id, path in self.runs:
                for nid in path:
                    if nid in needed and (cdata_id is None or cdata_id == nid):
                        said[nid].append((seq, data))
            out: dict[int, list[tuple]] = {}
            for nid, (tag, attrs, cards) in self.info.items():
                if nid in needed or attrs is not None:
                    read = self.read_of.get(nid)
                    for card in cards:
                        own = list(attrs.items()) if attrs is not None and (read or nid == card) else None
                        out.setdefault(card, []).append((nid, tag, own, read, self.marks.get(nid), self.links.get(nid), said.get(nid)))
            return [(card, elems, None) for card, elems in out.items()]

    def read(html: str) -> list[tuple]:
        reader = Reader()
        try:
            reader.read(html)
        except Exception as e:  # malformed beyond the parser: nothing of the page, a reason
            return [(ERROR_CARD, None, f"{type(e).__name__}: {e}")]
        return reader.parts()

    return read


def _page_task(make_reader: Callable, id_col: str, carried: list[str], schema_json: str, extra: str | None = None, max_rows: int = 20_000) -> Callable:
    """Pages → the rows their reader gives, with the page's ``id_col`` and ``carried`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(T.StructType.fromJson(json.loads(schema_json)))
        names = schema.names[1 + len(carried):]
        read = make_reader()
        for batch in batches:
            pages: list[int] = []
            rows: list[tuple] = []

            def made(batch=batch) -> pa.RecordBatch:
                take = pa.array(pages, pa.int64())
                columns = [batch.column(c).take(take) for c in (id_col, *carried)]
                columns += [pa.array([r[i] for r in rows], schema.field(n).type) for i, n in enumerate(names)]
                return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

            for i in range(batch.num_rows):
                html = batch.column("html")[i].as_py() or ""
                found = read(html) if extra is None else read(html, batch.column(extra)[i].as_py())
                pages += [i] * len(found)
                rows += found
                if len(rows) >= max_rows:  # bounded, whatever the batch holds (one page may exceed it)
                    yield made()
                    pages, rows = [], []
            if rows:
                yield made()

    return run


def parsed_pages(pages: DataFrame, make_reader: Callable, id_col: str, carried: list[str], fields: list[T.StructField], extra: str | None = None) -> DataFrame:
    src = pages.select(id_col, *carried, "html", *([extra] if extra else []))
    schema = T.StructType([*[src.schema[c] for c in (id_col, *carried)], *fields])
    return src.mapInArrow(_page_task(make_reader, id_col, carried, schema.json(), extra), schema)


def records_of(parts: DataFrame, page: list[str]) -> DataFrame:
    """One row a record from what the parser gave: ``elems`` (one entry an element, by place) and
    ``page_error``. Pages of the same id are one page, as they are to :func:`grouped_records`: an
    element then has the runs of all of them, those of one place as the pages came."""
    cards = parts.repartition(*page[:1], "card_id").groupBy(*page, "card_id").agg(
        F.collect_list("elems").alias("_lists"), F.max("page_error").alias("page_error"))
    every = F.flatten("_lists")
    ids = F.array_sort(F.array_distinct(F.transform(every, lambda e: e["elem_id"])))

    def merged(i: Column) -> Column:
        same = F.filter(every, lambda e: e["elem_id"] == i)
        first = lambda c: F.try_element_at(F.filter(F.transform(same, lambda e: e[c]), lambda x: x.isNotNull()), F.lit(1))
        has = F.exists(same, lambda e: e["runs"].isNotNull())
        runs = F.when(has, F.array_sort(F.flatten(F.transform(same, lambda e: F.coalesce(e["runs"], F.array()))), lambda a, b: a["seq"] - b["seq"]))
        return F.struct(i.alias("elem_id"), *[first(c).alias(c) for c in ("elem_tag", "attrs", "self_f", "par_marks", "first_desc_attr")], runs.alias("runs"))

    elems = F.when(F.size("_lists") > 1, F.transform(ids, merged)).otherwise(F.coalesce(F.try_element_at("_lists", F.lit(1)), F.array()))
    return cards.select(*page, "card_id", elems.alias("elems"), "page_error")


def element_text(e: Column, mode: str) -> Column:
    """The text of an element in a text mode: runs stripped and joined (a), joined and stripped (b),
    stripped and joined by a space (c)."""
    texts = F.transform(e["runs"], lambda r: r["text"])
    if mode == "text_b":
        joined = strip_ws(F.array_join(texts, ""))
    else:
        said = F.filter(F.transform(texts, lambda t: strip_ws(t)), lambda t: t != "")
        joined = F.array_join(said, "" if mode == "text_a" else " ")
    return F.when(e.isNotNull(), F.coalesce(joined, F.lit("")))


def first_element(field: str, parent: bool) -> Column:
    """The first element of ``elems`` that ``field`` matches, or the parent of the first match."""
    if not parent:
        hit = lambda e: F.array_contains(e["self_f"], field) & (e["elem_id"] != F.col("card_id"))
        return F.try_element_at(F.filter("elems", hit), F.lit(1))
    places = F.transform("elems", lambda e: F.array_min(F.transform(F.filter(e["par_marks"], lambda m: m["f"] == F.lit(field)), lambda m: m["o"])))
    return F.try_element_at(F.col("elems"), F.array_position(places, F.array_min(places)).cast("int"))


def record_cells(tag: Column) -> Column:
    """The cells of a record in order: ``id, text_a, link``."""
    cells = F.filter("elems", lambda e: (e["elem_tag"] == tag) & (e["elem_id"] != F.col("card_id")))
    return F.transform(cells, lambda e: F.struct(e["elem_id"].alias("id"), element_text(e, "text_a").alias("text_a"), e["first_desc_attr"].alias("link")))


def page_records(pages: DataFrame, id_col: str, spec: RecordSpec, keep: list[str] | None = None) -> DataFrame:
    """Pages (``id_col``, ``html``, ``keep``) → the records of ``spec``, each page parsed once.

    As :func:`extract_records` of the shredded pages; a page the parser gives up on is one record
    with ``page_error`` (null otherwise) and ``card_id`` -2. The input keeps its partitions."""
    keep = keep or []
    program = record_program(spec)
    cards = records_of(parsed_pages(pages, lambda: record_reader(program), id_col, keep, PART_FIELDS), [id_col, *keep])

    def value(f, e: Column) -> Column:
        return F.try_element_at(e["attrs"], F.lit(f.value[5:])) if f.value.startswith("attr:") else element_text(e, f.value)

    out = [F.try_element_at(F.filter("elems", lambda e: e["elem_id"] == F.col("card_id")), F.lit(1))["attrs"].alias("card_attrs")]
    found = cards.select("*", *[first_element(k, f.parent).alias(f"_{k}") for k, f in spec.fields.items()])
    for k in [k for k, f in spec.fields.items() if not f.parent] + [k for k, f in spec.fields.items() if f.parent]:
        out += [value(spec.fields[k], F.col(f"_{k}")).alias(k), F.col(f"_{k}").isNotNull().alias(f"{k}__found")]
    if spec.cells_tag:
        out.append(record_cells(F.lit(spec.cells_tag)).alias("cells"))
    return found.select(id_col, *keep, "card_id", *out, "page_error")


# --------------------------------------------------------------------------------------------
# Content under rules
# --------------------------------------------------------------------------------------------

FRAGMENT_FIELDS = [T.StructField("rule_no", T.IntegerType()), T.StructField("elem_id", T.IntegerType()),
                   T.StructField("seq", T.IntegerType()), T.StructField("text", T.StringType())]


class ContentRules:
    """One page's rules: chains of the container (or None), the selectors and what is removed; and
    the chains of the title."""

    def __init__(self, rules: dict, title: list[list[Step]]):
        chain = lambda c: [(s.get("tag"), tuple(s.get("classes") or ()), s.get("cls")) for s in c]
        selectors, remove = [chain(c) for c in rules.get("selectors") or []], [chain(c) for c in rules.get("remove") or []]
        container = rules.get("container")
        self.masks = StepMasks([c for c in [*selectors, *remove, *([chain(container)] if container is not None else []), *title]])
        ends = self.masks.ends
        self.selectors = [(r + 1, ends[r]) for r in range(len(selectors))]
        self.any = sum({e for _, e in self.selectors})
        self.remove = sum(ends[len(selectors):len(selectors) + len(remove)])
        self.whole = container is None
        self.scope = 0 if self.whole else ends[len(selectors) + len(remove)]
        self.title = sum(ends[len(ends) - len(title):]) if title else 0


def _content_reader(title: list[list[Step]]) -> Callable[[str, str], list[tuple]]:
    known: dict[str, ContentRules] = {}

    class Reader(TreeParser):
        def __init__(self, rules: ContentRules):
            super().__init__()
            self.rules = rules
            # of each open element: bits, removed, (rule, element) fragments it and those above it open
            self.open: list[tuple[int, bool, tuple]] = [(0, False, ())]
            self.scope_id: int | None = None
            self.title_id: int | None = None
            self.inside = rules.whole
            self.out: list[tuple] = []
            self.depth_of_scope = 0

        def element(self, nid, tag, attrs, stays_open):
            above, removed, fragments = self.open[-1]
            rules = self.rules
            new = rules.masks.enter(above, tag, attrs.get("class", ""))
            if new & rules.remove:
                removed = True
            if new and not removed:
                if self.inside and new & rules.any:
                    fragments = (*fragments, *((r, nid) for r, end in rules.selectors if new & end))
                if new & rules.scope and self.scope_id is None:
                    self.scope_id, self.depth_of_scope = nid, len(self.stack)
                    self.inside, fragments = stays_open, ()
                if new & rules.title and self.title_id is None:
                    self.title_id = nid
            if stays_open:
                self.open.append((above | new, removed, fragments))

        def cut(self, depth):
            del self.open[depth + 1:]
            if self.scope_id is not None and self.inside and depth <= self.depth_of_scope:
                self.inside = False

        def text(self, parent, data, cdata_id):
            _, removed, fragments = self.open[-1]
            if removed:
                return
            if self.inside:
                for rule, nid in fragments:
                    if cdata_id is None or cdata_id == nid:
                        self.out.append((rule, nid, self.seq, data))
            if self.title_id is not None and any(nid == self.title_id for nid, _ in self.stack) and (cdata_id is None or cdata_id == self.title_id):
                self.out.append((0, self.title_id, self.seq, data))

    def read(html: str, rules: str) -> list[tuple]:
        if rules not in known:
            if len(known) > 1000:
                known.clear()
            known[rules] = ContentRules(json.loads(rules), title)
        reader = Reader(known[rules])
        page = [(None, None, 0, None)]  # keeps a page without fragments
        try:
            reader.read(html)
        except Exception:  # malformed beyond the parser: nothing of the page
            return page
        return page + reader.out

    return read


def page_content(pages: DataFrame, id_col: str, keep: list[str] | None = None, title_selector: str | None = None) -> DataFrame:
    """Pages (``id_col``, ``html``, ``keep`` and the rule columns ``container``, ``selectors``,
    ``remove``) → one row a page: ``content`` under its rules and, with ``title_selector``, ``titulo``.

    As :func:`html_content` of the shredded pages, each page parsed once: no path and no rule leaves
    the parser, only the runs of fragments. A page the parser gives up on has no content. A title
    selector has no attribute tests."""
    keep = keep or []
    title = [list(c.steps) for c in parse_selector(title_selector)] if title_selector else []
    src = pages.withColumn("_rules", F.to_json(F.struct("container", "selectors", "remove")))
    rows = parsed_pages(src, lambda: _content_reader(title), id_col, keep, FRAGMENT_FIELDS, extra="_rules")
    piece = F.when(F.col("rule_no") > 0, F.nullif(strip_ws(F.col("text")), F.lit("")))
    rows = rows.select(id_col, *keep, "rule_no", "elem_id", "seq", piece.alias("_piece"), F.when(F.col("rule_no") == 0, F.col("text")).alias("_title_run"))
    aggs = [F.expr("listagg(_piece, ' ') within group (order by rule_no, elem_id, seq)").alias("_joined")]
    if title_selector:
        aggs.append(F.expr("listagg(_title_run, '') within group (order by seq)").alias("_title"))
    out = rows.groupBy(id_col, *keep).agg(*aggs)
    cols = [id_col, *keep, empty_to_null(collapse_ws(F.col("_joined"))).alias("content")]
    if title_selector:
        cols.append(strip_ws(F.coalesce(F.col("_title"), F.lit(""))).alias("titulo"))
    return out.select(*cols)
