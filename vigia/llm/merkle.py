"""Merkle dataset manifest: levels are built as parent-linked node rows, proofs climb by a recursive query.

The rows of each group (``lang``) are the leaves of one tree, in the order of their keys; the
subroots of all groups, in the order of the groups, are the leaves of the tree above. Every two
consecutive nodes of a level become their parent; a last node without a neighbour becomes one alone.

A node row holds what the climb needs of ``HOP`` levels at once: the steps (sibling digest and its
side, or none) from a node to its ancestor ``HOP`` levels up, and the key of the next row. Above
the leaves, the row of a node is stored once for every ``2**HOP`` leaves under it, so no key of the
climb is met by more rows than that, however few nodes a level has. One Spark recursive query
starts from every leaf, joins the next node row, appends its siblings and folds the claimed digest
through them until it has passed the last row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigia.llm.common import written

HOP = 8  # levels a node row spans by default: a task holds 2**HOP digests of one tile at once
LEFT, RIGHT, ALONE = b"L", b"R", b"N"  # on which side of the node its sibling stands


def _parent(run: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in run).encode()).digest()


def hop_steps(digests: list[bytes], levels: int | None) -> tuple[list[list[bytes]], bytes]:
    """The steps of every node of one tile and the digest they lead to: ``levels`` levels up, or
    (None: the tile is all that its tree has left) until one node remains."""
    steps: list[list[bytes]] = [[] for _ in digests]
    level, up = digests, 0
    while up < levels if levels is not None else len(level) > 1:
        for i, s in enumerate(steps):
            at = i >> up
            if at ^ 1 >= len(level):
                s.append(ALONE)
            else:
                s.append((RIGHT if at % 2 == 0 else LEFT) + level[at ^ 1])
        level = [_parent(level[k:k + 2]) for k in range(0, len(level), 2)]
        up += 1
    return steps, level[0]


def _hop_task(span: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"tree": [], "idx": [], "steps": [], "siblings": [], "up": [], "last": []}
            for tree, nodes, more in zip(*(batch.column(c).to_pylist() for c in ("tree", "nodes", "more"))):
                nodes = sorted((n["idx"], n["digest"]) for n in nodes)
                steps, top = hop_steps([d for _, d in nodes], span if more else None)
                out["tree"] += [tree] * len(nodes)
                out["idx"] += [i for i, _ in nodes]
                out["steps"] += steps
                out["siblings"] += [b"".join(x[1:] for x in s) for s in steps]
                out["up"] += [top] * len(nodes)
                out["last"] += [not more] * len(nodes)
            yield pa.RecordBatch.from_arrays([
                pa.array(out["tree"], pa.string()), pa.array(out["idx"], pa.int64()), pa.array(out["steps"], pa.list_(pa.binary())),
                pa.array(out["siblings"], pa.binary()), pa.array(out["up"], pa.binary()), pa.array(out["last"], pa.bool_())], list(out))

    return run


def _hop(nodes: DataFrame, span: int, name: str) -> DataFrame:
    """``tree, idx, steps, siblings, up, last`` of every node (``tree, idx, size, digest``): its steps
    and their digests alone, the digest they lead to, and whether that is the root of its tree."""
    tiles = nodes.groupBy("tree", F.shiftright("idx", span).alias("tile")).agg(
        F.collect_list(F.struct("idx", "digest")).alias("nodes"), (F.first("size") > (1 << span)).alias("more"))
    return written(tiles.select("tree", "nodes", "more").mapInArrow(
        _hop_task(span), "tree string, idx long, steps array<binary>, siblings binary, up binary, last boolean"), name)


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` (with a column ``tree``) and ``idx``, their place within the tree by ``order``, from
    0, and ``size``, the rows of the tree: a range sort, and running totals over one row a
    partition and tree."""
    by = [F.col("tree"), *order]
    laid = written(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                   .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    runs = laid.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "tree", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("n").over(Window.partitionBy("tree")).alias("size"))
    return laid.join(runs, ["part", "tree"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


@dataclass
class Manifest:
    """``leaves``: the rows given, each with ``tree, idx, tile`` and its first ``steps``; ``links``:
    the node rows above (``tree, hop, tile, steps, final, subroot``); ``root``: hex, null if empty."""
    leaves: DataFrame
    links: DataFrame
    root: str | None


def build(rows: DataFrame, order: list[Column], span: int = HOP) -> Manifest:
    """The manifest of ``rows``: ``tree`` (string, not null), ``digest`` (binary, the leaf) and any
    columns to carry; leaves of a tree ascend by ``order``, then by digest. A node row spans
    ``span`` levels."""
    leaves = numbered(rows, [*order, F.col("digest")], "merkle-leaves")
    nodes = leaves.select("tree", "idx", "size", "digest")
    hops: list[DataFrame] = []
    while True:
        hops.append(_hop(nodes, span, f"merkle-hop{len(hops)}"))
        nodes = hops[-1].filter("not last").groupBy("tree", F.shiftright("idx", span).alias("idx")).agg(F.first("up").alias("digest"))
        sizes = nodes.groupBy("tree").agg(F.count("*").alias("size"))
        if nodes.isEmpty():
            break
        nodes = nodes.join(sizes, "tree")
    subroots = hops[0].filter("last").select("tree", "up")
    for h in hops[1:]:
        subroots = subroots.union(h.filter("last").select("tree", "up"))
    subroots = written(subroots.groupBy("tree").agg(F.first("up").alias("digest")), "merkle-subroots")
    # the tree over the subroots, by the same hops; its nodes are known by the tree they stand for
    tops = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), [F.col("of")], "merkle-tops")
    tops = tops.select("of", "idx", "size", "digest")
    above: list[DataFrame] = []
    nodes, root = tops.select(F.lit("").alias("tree"), "idx", "size", "digest"), None
    while root is None:
        above.append(_hop(nodes, span, f"merkle-top{len(above)}"))
        ends = above[-1].filter("last").select("up").limit(1).collect()
        if ends or above[-1].isEmpty():
            root = ends[0][0].hex() if ends else None
            break
        nodes = above[-1].groupBy("tree", F.shiftright("idx", span).alias("idx")).agg(F.first("up").alias("digest"))
        nodes = nodes.withColumn("size", F.lit(nodes.count()).cast("long"))
    tiles = hops[0].select("tree", F.shiftright("idx", span).alias("tile")).distinct()
    tiles = written(tiles.join(tops.select(F.col("of").alias("tree"), F.col("idx").alias("top_idx"), F.col("digest").alias("subroot")), "tree"), "merkle-tiles")
    links = None
    for hop, h in enumerate(hops[1:], 1):  # node rows of a tree, once a tile of leaves below
        own = tiles.withColumn("idx", F.shiftright("tile", span * (hop - 1))).join(h.select("tree", "idx", "steps", "siblings"), ["tree", "idx"])
        own = own.select("tree", F.lit(hop).alias("hop"), "tile", "steps", "siblings", F.lit(False).alias("final"), "subroot")
        links = own if links is None else links.union(own)
    used = hops[0].filter("last").select("tree", F.lit(1).alias("hop")).distinct()  # the hop that leaves the tree
    for hop, h in enumerate(hops[1:], 1):
        used = used.union(h.filter("last").select("tree", F.lit(hop + 1).alias("hop")).distinct())
    used = tiles.join(used, "tree")
    for k, h in enumerate(above):
        own = used.withColumn("idx", F.shiftright("top_idx", span * k)).join(h.select("idx", "steps", "siblings"), "idx")
        own = own.select("tree", (F.col("hop") + k).alias("hop"), "tile", "steps", "siblings", F.lit(k == len(above) - 1).alias("final"), "subroot")
        links = own if links is None else links.union(own)
    leaves = leaves.join(hops[0].select("tree", "idx", "steps", "siblings"), ["tree", "idx"]).withColumn("tile", F.shiftright("idx", span))
    return Manifest(leaves, written(links, "merkle-links"), root)


#: The climb. A row is a leaf on its way: the digest folded so far and the siblings met.
CLIMB = """
WITH RECURSIVE climb(tree, tile, hop, id, digest, proof, final, subroot) AS (
    SELECT tree, tile, 1, id, {fold_first}, siblings, false, CAST(NULL AS BINARY)
    FROM {leaves}
    UNION ALL
    SELECT c.tree, c.tile, c.hop + 1, c.id, {fold_next}, concat(c.proof, n.siblings), n.final, n.subroot
    FROM climb c JOIN {links} n ON c.tree = n.tree AND c.hop = n.hop AND c.tile = n.tile)
SELECT {outputs} FROM climb WHERE final
"""


def _fold(digest: str, steps: str) -> str:
    hexed = "lower(hex(a))"
    other = "lower(hex(substring(s, 2)))"
    return (f"aggregate({steps}, {digest}, (a, s) -> unhex(sha2(CASE WHEN length(s) = 1 THEN {hexed} "
            f"WHEN substring(s, 1, 1) = X'{RIGHT.hex()}' THEN concat({hexed}, {other}) ELSE concat({other}, {hexed}) END, 256)))")


@contextmanager
def _no_row_limit(spark: SparkSession) -> Iterator[None]:
    """The recursive query emits a row a leaf and hop; Spark's default limit is a million rows."""
    key = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def climb(claims: DataFrame, links: DataFrame, outputs: tuple[str, ...] = ("id", "digest", "proof", "subroot")) -> DataFrame:
    """Each claim (``tree, tile, id, claimed, steps, siblings``; ``id`` is what the caller knows it
    by) folded to the root: ``outputs`` are expressions of ``id``, the folded ``digest``, the
    ``subroot`` and ``proof``, the siblings' digests (32 bytes each) from the leaf up. ``digest`` is
    the root only if the claimed leaf is the one the manifest was built from."""
    spark = claims.sparkSession
    with _no_row_limit(spark):
        claims.createOrReplaceTempView("vigia_merkle_claims")
        links.createOrReplaceTempView("vigia_merkle_links")
        try:
            query = CLIMB.format(leaves="vigia_merkle_claims", links="vigia_merkle_links", outputs=", ".join(outputs),
                                 fold_first=_fold("claimed", "steps"), fold_next=_fold("c.digest", "n.steps"))
            return written(spark.sql(query), "merkle-climb")
        finally:
            spark.catalog.dropTempView("vigia_merkle_claims")
            spark.catalog.dropTempView("vigia_merkle_links")


def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(_part, (doc_id, source, lang, n_chars, text))), 256))


def merkle_manifest(docs: DataFrame, span: int = HOP) -> DataFrame:
    """Per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    The manifest is built from the documents as they are; every row then claims its leaf, or,
    where 7 divides crc32(doc_id), a leaf with one more in ``n_chars`` (null stays null, so such a
    row is not altered; a null ``doc_id`` is never altered), and the climb folds the claim to
    ``folded_root``. Null ``lang`` is a group of its own, before all others; leaves ascend by
    ``doc_id`` (null first), ties by their digest, so equal rows are equal leaves side by side
    whose proofs may be told apart only by their order. Rows of one digest swap without effect.
    An empty table gives no rows. Only doc_id, source, lang, n_chars and text are read.
    """
    columns = [F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"), F.col("text").cast("string")]
    doc_id, source, lang, n_chars, text = columns
    leaf = leaf_digest(doc_id, source, lang, n_chars, text)
    hit = F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False)) & n_chars.isNotNull()
    rows = docs.select(F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("tree"), doc_id.alias("doc_id"), leaf.alias("digest"),
                       F.when(hit, leaf_digest(doc_id, source, lang, n_chars + 1, text)).alias("altered"))
    made = build(rows, [F.col("doc_id").asc_nulls_first()], span)
    claims = made.leaves.select("tree", "tile", F.struct("doc_id", "digest").alias("id"), F.coalesce("altered", "digest").alias("claimed"), "steps", "siblings")
    found = climb(claims, made.links, (
        "id.doc_id", "lower(hex(id.digest)) AS leaf", "lower(hex(subroot)) AS subroot", "sha2(lower(hex(proof)), 256) AS proof_sha256",
        "lower(hex(digest)) AS folded_root"))
    root = F.lit(made.root).cast("string")
    return found.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


#: Unsigned crc32 of an ASCII text in DuckDB SQL, bit by bit.
CRC32_SQL = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(range(1, length({0}) + 1), lambda i: ord(substr({0}, i, 1))::UBIGINT)), lambda a, b:
    list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda c, z:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)))"""


def _part_sql(value: str) -> str:
    return f"CASE WHEN ({value}) IS NULL THEN '-' ELSE strlen(CAST(({value}) AS VARCHAR)) || ':' || CAST(({value}) AS VARCHAR) END"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_part_sql(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels_sql(name: str, start: str) -> str:
    """Levels of the trees in ``start`` (tree, i from 0, h): all nodes of each, level by level."""
    return f"""{name}(level, tree, i, h, n) AS (
    SELECT 0, tree, i, h, count(*) OVER (PARTITION BY tree) FROM {start}
    UNION ALL
    SELECT level + 1, tree, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM {name} WHERE n > 1
    GROUP BY level, tree, i // 2)"""


#: The query in DuckDB SQL (doc_id is unique in the given tables).
ORACLE_SQL = f"""
WITH RECURSIVE rows AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql('n_chars')} AS leaf,
           CASE WHEN {CRC32_SQL.format('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} ELSE {_leaf_sql('n_chars')} END AS claimed
    FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST) - 1 AS i, leaf AS h FROM rows),
{_levels_sql('low', 'leaves')},
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS top FROM low WHERE n = 1),
tops AS (SELECT '' AS tree, top AS i, subroot AS h FROM subroots),
{_levels_sql('high', 'tops')},
nodes AS (
    SELECT level, tree, i, h, n FROM low UNION ALL SELECT level + 1000, NULL, i, h, n FROM high),
climb AS (
    SELECT doc_id, tree, 0 AS level, i, claimed AS folded, '' AS proof FROM leaves
    UNION ALL
    SELECT c.doc_id, CASE WHEN me.n > 1 THEN c.tree END, CASE WHEN me.n > 1 THEN c.level + 1 ELSE 1000 END,
           CASE WHEN me.n > 1 THEN c.i // 2 ELSE s.top END,
           CASE WHEN me.n = 1 THEN c.folded WHEN o.h IS NULL THEN sha256(c.folded)
                WHEN c.i % 2 = 0 THEN sha256(c.folded || o.h) ELSE sha256(o.h || c.folded) END,
           CASE WHEN me.n = 1 THEN c.proof ELSE c.proof || coalesce(o.h, '') END
    FROM climb c JOIN nodes me ON me.level = c.level AND me.tree IS NOT DISTINCT FROM c.tree AND me.i = c.i
    LEFT JOIN nodes o ON o.level = c.level AND o.tree IS NOT DISTINCT FROM c.tree AND o.i = xor(c.i, 1)
    LEFT JOIN subroots s ON s.tree = c.tree
    WHERE me.n > 1 OR c.level < 1000),
ends AS (SELECT doc_id, folded, proof FROM climb JOIN nodes USING (level, i) WHERE level >= 1000 AND nodes.n = 1)
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = r.h AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN ends e ON e.doc_id = l.doc_id, (SELECT h FROM high WHERE n = 1) r
"""
