"""op13 against a plain trie: shared heads, hot first turns, turnless conversations, spilled queues."""

import hashlib
import os
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from vigia.llm.prefix_trie import ORACLE_SQL, SpillingQueue, prefix_trie, shared_head_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows, group=5, heads=9):
    """Turns (role, text) of every rebuilt conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads if heads else 0
        out[c] = own.get(c - c % group, [])[:h] + ts[h:]
    return out


def plain(seqs):
    nodes = {}
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            nodes.setdefault(tuple(seqs[c][:d]), []).append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = leaves[p] or 1
        saved[p] += (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        if p:
            kids[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = []
    for p, members in nodes.items():
        last = ",".join(str(c) for c in members if len(seqs[c]) == len(p))
        out.append((members[0], len(p), nodes[p[:-1]][0] if p else None, len(members), kids[p], leaves[p], saved[p], hashlib.sha256(last.encode()).hexdigest()))
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("k")).withColumn("depth", F.lit(None).cast("string")).withColumn("N", F.lit(1))


def run(spark, rows, **how):
    return Counter(tuple(r) for r in shared_head_trie(frame(spark, rows), **how).collect())


EDGE = [(1, 0, "user", "a"), (1, None, None, "ñ €"), (1, 0, "user", "a"), (0, 3, "user", None), (0, 3, None, ""), (0, 2, "x", "y" * 50_000),
        (7, None, None, None), (None, 0, "user", "lost"), (12, 5, "user", "a"), (10, 1, "user", "a"), (11, 0, "use", "ra"), (11, 1, "user", "a")]


@pytest.mark.parametrize("rows", [[], [(3, 0, "u", "t")], EDGE], ids=["empty", "one", "edge"])
def test_small(spark, rows):
    assert run(spark, rows) == plain(sequences(rows))


def crowd(n=400):
    """A first turn that a third share, copies, and conversations of up to 30 turns."""
    rng, rows = random.Random(4), []
    for c in range(n):
        first = "hello" if c % 3 == 0 else f"hi {rng.randrange(40)}"
        rows += [(c, t, "user" if t % 2 == 0 else "bot", first if t == 0 else f"w{rng.randrange(3)}é") for t in range(1 + rng.randrange(8 if c % 20 else 30))]
    return rows


@pytest.mark.parametrize("how", [{}, {"shard": 7}, {"shard": 3, "queue": 2}], ids=["one shard", "many shards", "spilling"])
def test_rounds_and_spills_change_nothing(spark, how):
    rows = crowd()
    assert run(spark, rows, **how) == plain(sequences(rows))


def test_without_shared_heads(spark):
    rows = crowd(100)
    got = Counter(tuple(r) for r in prefix_trie(frame(spark, rows), shard=5).collect())
    assert got == plain(sequences(rows, heads=0))


def test_long_conversation(spark):
    rows = [(5, t, "user", f"t{t % 11}") for t in range(1200)] + [(6, t, "user", f"t{t % 11}") for t in range(30)]
    assert run(spark, rows, shard=1) == plain(sequences(rows))


def test_given_table_and_sql(spark):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF_CHECK}/conversations.parquet'")
    given = spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
    got = Counter(tuple(r) for r in shared_head_trie(given).collect())
    assert got == plain(sequences([tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]))
    assert got == Counter(db.sql(ORACLE_SQL).fetchall())


def test_queue_keeps_order_and_cleans_up(tmp_path):
    rng, queue, want = random.Random(1), SpillingQueue(f"file://{tmp_path}", 8), Counter()
    targets = [(d, bytes([k]) * 32) for d in range(5, 0, -1) for k in range(4)]
    for i, (depth, key) in enumerate(targets):
        for _ in range(rng.randrange(20)):
            to = rng.choice(targets[i:])
            queue.push(*to, 1, 2, 3)
            want[to] += 1
        n = want.pop((depth, key), 0)
        assert queue.pop(depth, key) == (n, 2 * n, 3 * n)
    assert not queue.heap and not queue.heads and not os.listdir(tmp_path)
