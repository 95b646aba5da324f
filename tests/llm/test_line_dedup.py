import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from vigia.llm.line_dedup import ORACLE_SQL, line_dedup, repeated_runs


def brute(rows, n=2):
    """``rows`` in corpus order."""
    filled = [[(at, line) for at, line in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", line)] for _, t in rows]
    seen, out = set(), []
    for (d, t), lines in zip(rows, filled):
        gone = set()
        for j in range(len(lines) - n + 1):
            key = tuple(x for _, x in lines[j:j + n])
            if key in seen:
                gone |= set(range(j, j + n))
            seen.add(key)
        cut = {lines[j][0] for j in gone}
        kept = "\n".join(x for at, x in enumerate((t or "").split("\n")) if at not in cut)
        out.append((d, len(lines), len(gone), sum(j - 1 not in gone for j in gone), kept, hashlib.md5(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_against_brute_force(spark, n):
    r = random.Random(n)
    pool = [f"line {i}" for i in range(25)] + ["", " \t", "é"]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 30)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, rows[3][1]), (54, "x\n" * 50), (55, "\n".join(f"u{i}" for i in range(30_000))), (56, rows[3][1])]
    df = spark.createDataFrame([(i, t, "k", 3) for i, t in rows], "doc_id long, text string, h string, gone int").repartition(3)
    assert sorted(map(tuple, line_dedup(df, min_lines=n).collect()), key=repr) == brute(rows, n)


def test_repeated_and_null_ids(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb"), (1, "a\nb"), (2, "z"), (2, "z")]
    got = sorted(map(tuple, line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_removed").collect()), key=repr)
    assert got == sorted([(None, 0), (1, 2), (1, 2), (2, 0), (2, 0)], key=repr)
    same = spark.createDataFrame([(None, "a\nb")] * 3, "doc_id long, text string")
    assert sorted(r.n_removed for r in line_dedup(same).collect()) == [0, 2, 2]


def test_sql_on_the_whole_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_CHECK}/documents.parquet')")
    want = sorted(con.execute(ORACLE_SQL).fetchall())
    got = line_dedup(spark.read.parquet(f"{SF_CHECK}/documents.parquet")).drop("kept")
    assert sorted(map(tuple, got.collect())) == want
    assert sum(r[2] for r in want) > 0


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def brute_by_words(rows, n, line_words, whole):
    """``rows`` in corpus order: lines that go of each by the rule of runs, of long lines and of whole documents."""
    filled = [[line for line in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)] for _, t in rows]
    runs, lines, texts, out = set(), set(), set(), []
    for (d, _), own in zip(rows, filled):
        gone = set()
        for j, line in enumerate(own):
            run = tuple(own[j:j + n])
            if len(run) == n and run in runs:
                gone |= set(range(j, j + n))
            if line in lines and len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= line_words:
                gone.add(j)
            runs.add(run)
            lines.add(line)
        if whole and tuple(own) in texts:
            gone = set(range(len(own)))
        texts.add(tuple(own))
        out.append((d, len(gone), sum(j - 1 not in gone for j in gone), "\n".join(x for j, x in enumerate(own) if j not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n,whole", [(2, True), (3, True), (3, False)])
def test_long_lines_and_whole_documents(spark, n, whole):
    r = random.Random(n)
    paragraph = " ".join(f"w{i}" for i in range(50))
    pool = [f"line {i}" for i in range(200)] + [paragraph, "  " + paragraph[4:] + "\t", paragraph.replace(" ", "\t\t"), "é"]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 12)))) for i in range(60)]
    rows += [(100, f"before\n{paragraph}\nafter"), (101, f"other\n{paragraph}\nneighbours"), (102, "one line"), (103, "one line"), (104, "one line\n\n "),
             (105, "two\nlines"), (106, "two\nlines"), (107, "one line\nand more"), (108, paragraph), (108, paragraph), (109, "short"), (109, "short"), (110, None), (111, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = line_dedup(df, min_lines=n, line_words=50, whole_documents=whole).collect()
    kept = lambda t: "\n".join(x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    assert sorted(((g.doc_id, g.n_removed, g.n_runs, kept(g.kept)) for g in got), key=repr) == brute_by_words(rows, n, 50, whole)
    removed = {g.doc_id: g.n_removed for g in got}
    assert removed[101] == 1 and removed[103] == removed[104] == whole and removed[107] == 0


def test_runs_are_followed_to_their_full_length(spark):
    """Copies of long runs, runs that overlap themselves, and a run shared from its middle on."""
    rng = random.Random(11)
    block = [f"line {rng.randrange(10 ** 6)}" for _ in range(100)]
    rows = [(1, "\n".join(block)), (2, "own\n" + "\n".join(block[20:90]) + "\nend"), (3, "\n".join(["same"] * 70)), (4, "\n".join(block[:50] + ["x"] + block[50:]))]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.kept for r in line_dedup(texts).collect()}
    assert got == {1: rows[0][1], 2: "own\nend", 3: "same", 4: "x"}
    k, h = F.coalesce("doc_id", F.lit(0)).alias("k"), F.xxhash64("text").alias("h")
    runs = repeated_runs(texts.select(k, h, "text"), 2).collect()
    deepest = {}
    for r in runs:
        deepest[r.k] = max(deepest.get(r.k, 0), r.w)
    assert deepest == {2: 64, 3: 64, 4: 32}
    assert {(r.i, r.w) for r in runs if r.k == 2} == {(1 + i, w) for w in (2, 4, 8, 16, 32, 64) for i in range(70 - w + 1)}
