import numpy as np
import pyarrow as pa

from vigia.llm.toxicity import fit_ordinal, fit_toxicity, score_toxicity

SF_LARGER = "/root/testdata/sf0.1"


def test_held_out_toxic_documents_are_caught_and_clean_ones_left(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGER}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter("doc_id % 3 <> 1")
    got = {r.doc_id: r for r in score_toxicity(docs, train).collect()}
    assert len(got) == docs.count()
    held = labels.filter("doc_id % 3 = 1").collect()
    caught = np.mean([got[r.doc_id].toxic for r in held if r.toxic])
    wrong = np.mean([got[r.doc_id].toxic for r in held if not r.toxic])
    print(caught, wrong)
    # about one labelled toxic row in eight of this table holds no word that only toxic rows hold
    assert caught >= 0.8 and wrong <= 0.01
    assert all(0 <= r.severity <= 3 and (r.severity >= r.p_toxic - 1e-9) for r in got.values())


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "idiot word", 3), (4, "a " * 200_000, 4), (4, "x", 5)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, 1, "t"), (2, 0, "t"), (4, 0, "t"), (4, 1, "t"), (None, 1, "t"), (9, None, "t")], "doc_id long, toxic int, text string")
    assert len(score_toxicity(docs, labels).collect()) == 5
    assert {r.toxic for r in score_toxicity(docs, labels.limit(0)).collect()} == {0}
    assert score_toxicity(docs.limit(0), labels).collect() == []


def test_fit_recovers_ordered_thresholds():
    rng = np.random.default_rng(0)
    n, m = 6000, 8
    x = rng.random((n, m)) < 0.3
    w = np.array([2.0, -1.5, 1, 0, 0, 0.5, -0.5, 3])
    u = x @ w + rng.logistic(size=n)
    grade = np.searchsorted([0.0, 1.5, 3.0], u)
    rows, cols = np.nonzero(x)
    got, cuts = fit_ordinal(rows, cols, n, m, grade, steps=600)
    assert np.abs(got - w).max() < 0.35 and (np.diff(cuts) > 0).all() and np.abs(cuts - [0, 1.5, 3]).max() < 0.35


def test_severity_follows_toxic_words(spark):
    rows = [(i, "fine words here " + ("scum " * (1 + i % 6) if i % 3 == 0 else "") + f"n{i % 7}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit_toxicity(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    s, p = model.severity(pa.array(["fine words here", "scum", "n1"]))
    assert p[1] > 0.5 > p[0] and s[1] > s[0] and (np.diff(model.thresholds) > 0).all()
