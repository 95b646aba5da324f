import math
import re
from collections import defaultdict

import pytest

from tests.conftest import SF_CHECK
from vigia.llm.mixing import mix_sources, mixed_documents


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(rows, weights=(5, 2, 1), cap=3.0):
    total = defaultdict(int)
    for _, t, s in rows:
        total[s] += size(t)
    order = sorted(total, key=lambda s: (s is None, (s or "").encode("utf-8")))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    out, free, left = {}, set(order), float(sum(total.values()))
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if w[s] * level > cap * total[s]}
        for s in full or free:
            out[s] = cap * total[s] if full else w[s] * level
        left -= sum(out[s] for s in full)
        free -= full or free
    return total, out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, s, 1.0, "c") for i, t, s in rows], "doc_id long, text string, source string, target double, copies string")
    return mix_sources(df.repartition(3), **kw).collect()


def test_targets_rates_and_reruns(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "source")
    rows = [tuple(r) for r in docs.collect()]
    total, want = targets(rows)
    got = mix_sources(docs).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    sizes = {i: size(t) for i, t, _ in rows}
    for r in got:
        assert r["size"] == sizes[r.doc_id] and r.taken <= 3 * r["size"] and r.taken % max(r["size"], 1) == 0
        assert r.source_size == total[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        taken[r.source] += r.taken
    for s in total:
        assert abs(taken[s] - want[s]) <= 0.01 * want[s]
    assert math.isclose(sum(want.values()), sum(total.values()))
    again = mix_sources(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_tilt_follows_size(spark):
    rows = [(i, "w " * (1 + i % 40), s) for i in range(800) for s in ("a", "b")]
    got = run(spark, rows)
    mean = lambda s, f: sum(r.copies for r in got if r.source == s and f(r["size"])) / sum(1 for r in got if r.source == s and f(r["size"]))
    assert mean("a", lambda n: n > 30) > mean("a", lambda n: n < 10)  # a gains: long documents tilt up
    assert mean("b", lambda n: n > 30) < mean("b", lambda n: n < 10)  # b loses


@pytest.mark.parametrize("bucket_rows", [4, 256])
def test_nulls_ties_hot_groups(spark, bucket_rows):
    rows = ([(i, "same words here", "hot") for i in range(300)] + [(None, "x y", None), (None, None, None), (1, "", "é"), (1, "", "é"),
            (2, "only one", "z"), (3, " ".join(["w"] * 20_000), "long"), (4, "a b", "long")] + [(9, "rep eat", "hot")] * 20)
    total, want = targets(rows)
    got = run(spark, rows, bucket_rows=bucket_rows)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= 3 and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        taken[r.source] += r.taken
    assert abs(taken["hot"] - want["hot"]) <= 3
    assert taken[None] == round(want[None]) or abs(taken[None] - want[None]) <= 2


def test_documents_as_often_as_taken(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame([(i, t, s, i) for i, t, s in rows], "doc_id long, text string, source string, size int")
    want = sorted((r.doc_id, r.copies) for r in mix_sources(df).collect() if r.copies)
    out = mixed_documents(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r["count"]) for r in out.groupBy("doc_id").count().collect()) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(df).collect() == [] and mixed_documents(df).collect() == []
