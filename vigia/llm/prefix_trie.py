"""Conversation prefix trie, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns, known by a chain of SHA-256 digests; the nodes on a
conversation's path come from one pass over sorted turns. Nodes are cut into shards by the number
of conversations through them: with thresholds T, T**2, ... a shard is all nodes of one size class
under a common topmost one, so that it holds at most T nodes a depth, however many conversations
share a first turn and however many children the root has.

Within a task the nodes of a shard arrive sorted by reverse level (deepest first), then by key.
Each takes the messages addressed to it from a priority queue, adds its own part, and sends its
totals forward to its parent, which comes later in that order. The queue keeps a bounded number of
messages in memory and spills the rest as sorted runs. The topmost node of a shard sends its
message across shards: such messages are summed per parent by Spark and enter the next round, the
shards of the next size class, up to the root.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import scratch, written

ROOT = bytes(32)
SHARD = 512  # T: conversations through the topmost node of a shard of the first round
QUEUE = 1 << 16  # messages a queue keeps in memory
IDS = 4096  # ids of conversations in one piece of a node's list


class SpillingQueue:
    """Messages to nodes in reverse level order; more than ``limit`` go to sorted runs in ``folder``
    (shared storage: a run is read back by the task that wrote it, and then deleted).

    Targets are popped in that order, and nothing is pushed to a target already passed, so runs
    are merged from their heads and never read twice.
    """

    _record = struct.Struct("<q32sqqq")

    def __init__(self, folder: str, limit: int = QUEUE):
        self.folder, self.limit = folder, limit
        self.heap: list[tuple[int, bytes, int, int, int]] = []
        self.heads: list[tuple[tuple[int, bytes, int, int, int], int]] = []
        self.runs: list[Iterator[tuple[int, bytes, int, int, int]]] = []

    def push(self, depth: int, key: bytes, children: int, leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (-depth, key, children, leaves, saved))
        if len(self.heap) > self.limit:
            self._spill()

    def pop(self, depth: int, key: bytes) -> tuple[int, int, int]:
        """Children, leaves and saved tokens that were sent to this node."""
        at, total = (-depth, key), [0, 0, 0]
        while self.heap and self.heap[0][:2] == at:
            total = [a + b for a, b in zip(total, heapq.heappop(self.heap)[2:])]
        while self.heads and self.heads[0][0][:2] == at:
            message, run = self.heads[0]
            total = [a + b for a, b in zip(total, message[2:])]
            follow = next(self.runs[run], None)
            heapq.heapreplace(self.heads, (follow, run)) if follow else heapq.heappop(self.heads)
        return total[0], total[1], total[2]

    def _spill(self) -> None:
        store, folder = fs.FileSystem.from_uri(self.folder)
        store.create_dir(folder, recursive=True)
        path = f"{folder}/run-{uuid.uuid4().hex}"
        with store.open_output_stream(path) as out:
            for message in sorted(self.heap):
                out.write(self._record.pack(*message))
        self.heap = []
        self.runs.append(self._read(store, path))
        heapq.heappush(self.heads, (next(self.runs[-1]), len(self.runs) - 1))

    def _read(self, store: fs.FileSystem, path: str) -> Iterator[tuple[int, bytes, int, int, int]]:
        size = self._record.size
        with store.open_input_stream(path) as source:
            while data := source.read(size * 1024):
                yield from self._record.iter_unpack(data)
        store.delete_file(path)


# ---- paths ---------------------------------------------------------------------------------

def _paths_task(max_head: int) -> Callable:
    """Rows sorted by group, owner first, conversation, turn → the nodes each conversation passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = conv = held = None
        shared: list[tuple[bytes, int]] = []  # the first links of the group's owner
        for batch in batches:
            out: list[tuple[int, int, bytes, bytes | None, int, bool]] = []
            for b, c, head, x, size in zip(*(batch.column(k).to_pylist() for k in ("base", "conv_id", "head", "digest", "size"))):
                if b != base:
                    base, shared = b, []
                if c != conv:
                    if held:
                        out.append((*held, True))
                    conv, place, held = c, 0, (c, 0, ROOT, None, 0)
                    if c != b:
                        for key, n in shared[:head]:
                            out.append((*held, False))
                            held = (c, held[1] + 1, key, held[2], n)
                if c == b or place >= head:
                    out.append((*held, False))
                    held = (c, held[1] + 1, hashlib.sha256(held[2] + x).digest(), held[2], size)
                    if c == b and len(shared) < max_head:
                        shared.append((held[2], size))
                place += 1
            yield _path_rows(out)
        if held:
            yield _path_rows([(*held, True)])

    return run


def _path_rows(out: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
    names = ("conv_id", "depth", "key", "parent", "size", "last")
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)


def paths(conversations: DataFrame, base: Column, head: Column, max_head: int) -> DataFrame:
    """``conv_id, depth, key, parent, size, last``: every conversation at every node on its path,
    the root included; ``size`` is the bytes of the node's last text, ``last`` its end."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size")).filter("conv_id IS NOT NULL")
    turns = turns.select("*", base.alias("base"), head.cast("int").alias("head"))
    laid = turns.repartition("base").sortWithinPartitions("base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "digest")
    return laid.select("base", "conv_id", "head", "digest", "size").mapInArrow(
        _paths_task(max_head), "conv_id long, depth long, key binary, parent binary, size long, last boolean")


# ---- shards --------------------------------------------------------------------------------

def shard_nodes(rows: DataFrame, shard: int) -> tuple[DataFrame, int]:
    """One row a node (``key, parent, depth, conv_id, parent_conv_id, n_convs, size, level, shard,
    top``) and the number of rounds. ``rows`` are written paths."""
    counts = written(rows.groupBy("key").agg(F.min("conv_id").alias("least"), F.count("*").alias("n")), "trie-counts")
    whole = counts.filter(F.col("key") == F.lit(ROOT)).collect()
    total, first = (whole[0]["n"], whole[0]["least"]) if whole else (0, None)
    bounds = [shard]
    while bounds[-1] < total:
        bounds.append(bounds[-1] * max(shard, 2))

    def level(n: Column) -> Column:
        out = F.lit(len(bounds) - 1)
        for r in range(len(bounds) - 2, -1, -1):
            out = F.when(n <= bounds[r], F.lit(r)).otherwise(out)
        return out

    # counts are written, not aggregated below the join: a hot prefix's side can then be split
    path, along = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("depth")
    on_path = rows.filter("depth > 0").join(counts, "key").withColumn("level", level(F.col("n")))
    cuts = F.array(*[F.min_by("key", F.when(F.col("n") <= b, F.col("depth"))).over(path) for b in bounds])
    on_path = on_path.select(
        "*", F.coalesce(F.lag("least").over(along), F.lit(first).cast("long")).alias("parent_conv_id"),
        (F.col("level") != F.coalesce(F.lag("level").over(along), F.lit(len(bounds) - 1))).alias("top"), F.element_at(cuts, F.col("level") + 1).alias("shard"))
    nodes = on_path.filter("conv_id = least").select("key", "parent", "depth", "conv_id", "parent_conv_id", F.col("n").alias("n_convs"), "size", "level", "shard", "top")
    root = counts.filter(F.col("key") == F.lit(ROOT)).select(
        "key", F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.col("least").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.lit(0).cast("long").alias("size"),
        F.lit(len(bounds) - 1).alias("level"), F.col("key").alias("shard"), F.lit(False).alias("top"))
    # a first turn of the last size class belongs to the shard of the root
    to_root = F.when((F.col("level") == len(bounds) - 1), F.lit(ROOT)).otherwise(F.col("shard"))
    return written(nodes.withColumn("shard", to_root).union(root), "trie-nodes"), len(bounds)


# ---- time-forward processing ---------------------------------------------------------------

def _forward_task(folder: str, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(folder, limit)
        for batch in batches:
            out: list[tuple] = []
            rows = (batch.column(k).to_pylist() for k in ("key", "parent", "depth", "n_convs", "size", "top", "children", "leaves", "saved"))
            for key, parent, depth, n, size, top, children, leaves, saved in zip(*rows):
                sent = queue.pop(depth, key)
                children, leaves, saved = children + sent[0], leaves + sent[1], saved + sent[2] + (n - 1) * size
                leaves = leaves if children else 1
                if not top and parent is not None:
                    queue.push(depth - 1, parent, 1, leaves, saved)
                out.append((key, parent if top else None, children, leaves, saved))
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             ["key", "above", "n_children", "n_leaves", "saved_tokens"])

    return run


def subtree_totals(nodes: DataFrame, rounds: int, limit: int) -> DataFrame:
    """``key, above, n_children, n_leaves, saved_tokens`` of every node, in ``rounds`` rounds."""
    folder = scratch(nodes.sparkSession, "trie-queues")
    done = None
    for r in range(rounds):
        own = nodes.filter(F.col("level") == r)
        if done is None:
            own = own.select("*", *[F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")])
        else:
            sent = written(done.filter("above IS NOT NULL").groupBy(F.col("above").alias("key")).agg(
                F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")), f"trie-sent{r}")
            own = own.join(sent, "key", "left").fillna(0, ["children", "leaves", "saved"])
        laid = own.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "key")
        totals = written(laid.select("key", "parent", "depth", "n_convs", "size", "top", "children", "leaves", "saved").mapInArrow(
            _forward_task(folder, limit), "key binary, above binary, n_children long, n_leaves long, saved_tokens long"), f"trie-totals{r}")
        done = totals if done is None else done.union(totals)
    return done


# ---- ends ----------------------------------------------------------------------------------

def _ends_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, digest = None, None

    def rows(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["key", "ends_sha256"])

    for batch in batches:
        done = []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key != at:
                if at is not None:
                    done.append((at, digest.hexdigest()))
                at, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield rows(done)
    if at is not None:
        yield rows([(at, digest.hexdigest())])


def ends(rows: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the conversations that end at a node, in pieces of at most ``IDS`` ids
    joined before the exchange that brings a node's pieces together; the digest streams them."""
    pieces = rows.filter("last").groupBy("key", F.floor(F.col("conv_id") / IDS).alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("key", "piece", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    laid = pieces.repartition("key").sortWithinPartitions("key", "piece")
    return laid.select("key", "ids").mapInArrow(_ends_task, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, *, base: Column | None = None, head: Column | None = None, max_head: int = 0,
                shard: int = SHARD, queue: int = QUEUE) -> DataFrame:
    """Per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` of the trie of ``conversations`` (``conv_id, turn, role, text``).

    A conversation is its rows by ``turn`` (null first; ties by a digest of role and text); null role
    or text is empty. With ``base`` and ``head`` (columns of ``conv_id``), it takes its first
    ``head`` (at most ``max_head``) turns from conversation ``base`` (fewer, if that has fewer;
    none, if it is absent) and goes on with its own turns after its first ``head``.
    Each distinct sequence of first turns is a node, from the root without a text; a node is told by
    ``conv_id`` (its smallest member) and ``depth``. ``n_leaves`` counts the childless nodes of its
    subtree, itself included; ``saved_tokens`` sums (members - 1) x bytes of the last text over the
    subtree; ``ends_sha256`` digests the ids, ascending, of conversations that end at the node.
    Equal rows are separate turns. Rows without ``conv_id`` take no part. An empty table has no
    nodes, not even a root. A conversation is read as a sorted stream: its length is unbounded,
    its turns stay in one task. Other columns are not read.
    """
    conv = F.col("conv_id")
    rows = written(paths(conversations, conv if base is None else base, F.lit(0) if head is None else head, max_head), "trie-paths")
    nodes, rounds = shard_nodes(rows, shard)
    totals = subtree_totals(nodes, rounds, queue)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(totals, "key").join(ends(rows), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))


def shared_head_trie(conversations: DataFrame, group: int = 5, heads: int = 9, **how: int) -> DataFrame:
    """The trie of conversations rebuilt on the first turns of the first one of each ``group``."""
    conv = F.col("conv_id")
    return prefix_trie(conversations, base=conv - F.pmod(conv, F.lit(group)), head=F.crc32(conv.cast("string")) % heads, max_head=heads - 1, **how)


_CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(range(1, length(s) + 1), lambda i: ord(substr(s, i, 1))::UBIGINT)), lambda a, b:
    list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda c, z:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)))"""

#: The registered query in DuckDB SQL (conversation ids are not negative in the given tables).
ORACLE_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x
    FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS place FROM turns),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS head FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM turns)),
rebuilt AS (
    SELECT c.conv_id, 0 AS part, p.place, p.x, p.size FROM convs c JOIN placed p ON p.conv_id = c.base AND p.place <= c.head
    UNION ALL
    SELECT c.conv_id, 1, p.place, p.x, p.size FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.head),
passed AS (
    SELECT conv_id, row_number() OVER w AS depth, string_agg(x, '') OVER w AS node, size FROM rebuilt
    WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, left(node, greatest(length(node) - 64, 0)) AS parent
          FROM passed GROUP BY node, depth),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (SELECT DISTINCT a.node AS top, b.node FROM passed a JOIN passed b ON b.conv_id = a.conv_id AND b.depth >= a.depth),
totals AS (SELECT b.top AS node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved
           FROM below b JOIN nodes n ON n.node = b.node LEFT JOIN children c ON c.node = b.node GROUP BY b.top),
ends AS (SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
         FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) AS k FROM passed) WHERE k = 1 GROUP BY node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(c.n, 0) AS BIGINT) AS n_children,
       CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.parent LEFT JOIN children c ON c.node = n.node
JOIN totals t ON t.node = n.node LEFT JOIN ends e ON e.node = n.node
"""
