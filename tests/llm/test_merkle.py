"""op12 against a plain Merkle tree: odd levels, null groups, repeated rows, tampering, many tiles."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from vigia.llm.merkle import ORACLE_SQL, hop_steps, merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    n = None if r["n_chars"] is None else r["n_chars"] + more
    return H(*map(part, (r["doc_id"], r["source"], r["lang"], n, r["text"])))


def climb_plain(levels, i, digest):
    """The siblings of leaf i, and ``digest`` folded to the root."""
    proof = []
    for level in levels[:-1]:
        run = level[i // 2 * 2:i // 2 * 2 + 2]
        proof += [x for k, x in enumerate(run) if k != i % 2]
        digest = H(*[digest if k == i % 2 else x for k, x in enumerate(run)])
        i //= 2
    return proof, digest


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k:k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    root = top[-1][0] if names else None
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            low, digest = climb_plain(trees[g], i, leaf(r, 1 if hit else 0))
            high, digest = climb_plain(top, k, digest)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root, H(*low, *high), digest, digest == root))
    return out


def run(spark, rows, **how):
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    clash = docs.withColumn("tree", F.lit(1)).withColumn("idx", F.lit("x")).withColumn("digest", F.lit(None).cast("string")).withColumn("Size", F.lit(2))
    return [tuple(r) for r in merkle_manifest(clash, **how).collect()]


def row(i, lang, text="t", n=3, source="s"):
    return {"doc_id": i, "lang": lang, "text": text, "n_chars": n, "source": source}


EDGE = [row(5, "es"), row(-3, "es", None), row(None, "es", "ñandú €"), row(0, None, ""), row(1, "", "x" * 100_000), row(7, "de", n=None),
        row(9, "de"), row(9, "de", "other"), row(8, "de"), row(8, "de"), row(None, None, None, None, None)]


@pytest.mark.parametrize("rows", [[], [row(4, "a")], EDGE, [row(i, None) for i in range(5)]], ids=["empty", "one", "edge", "null group"])
def test_small_trees(spark, rows):
    assert Counter(run(spark, rows)) == Counter(plain(rows))


def test_trees_of_many_tiles_and_groups(spark):
    rows = [row(i * 3, "ab"[i % 7 == 0], f"text {i}") for i in range(150)] + [row(1000 + i, f"g{i}") for i in range(19)]
    got, want = run(spark, rows, span=2), plain(rows)  # four leaves a tile: several hops even for small trees
    assert Counter(got) == Counter(want)
    assert {r[6] for r in got} == {True, False}


def test_whole_table_with_hops_of_256(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert Counter(tuple(r) for r in merkle_manifest(docs).collect()) == Counter(plain([r.asDict() for r in docs.collect()]))


def test_sql_says_the_same(spark):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_CHECK}/documents.parquet'")
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert Counter(db.sql(ORACLE_SQL).fetchall()) == Counter(tuple(r) for r in merkle_manifest(docs).collect())


def test_row_limit_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    run(spark, [row(1, "a")])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before


def test_a_lone_last_node_rises_alone():
    steps, top = hop_steps([b"\0" * 32, b"\1" * 32, b"\2" * 32], 3)
    assert [s[0][:1] for s in steps] == [b"R", b"L", b"N"] and [s[2] for s in steps] == [b"N"] * 3
    low = H((b"\0" * 32).hex(), (b"\1" * 32).hex()), H((b"\2" * 32).hex())
    assert top.hex() == H(H(*low))
