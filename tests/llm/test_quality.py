import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_CHECK
from vigia.llm.quality import STATS, fit_rules, keep_good, score_quality, statistics


def test_held_out_accuracy_and_whole_table(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = score_quality(docs, labels).collect()
    assert len(got) == docs.count()
    label = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) >= 0.93
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.predicted)


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - quality else quality end as quality")
    a, b = (sorted(map(tuple, score_quality(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_edge_rows(spark):
    r = random.Random(0)
    good = " ".join("word%d" % r.randrange(999) for _ in range(300))
    rows = [(1, None), (2, ""), (3, "  \n\n "), (None, good), (5, good * 300), (5, good * 300), (6, "!!!"), (7, "\n")]
    docs = spark.createDataFrame([(i, t, "x", 2) for i, t in rows], "doc_id long, text string, s_words string, quality int")
    labels = spark.createDataFrame([(1, 0, "a"), (5, 1, "b"), (5, None, "c"), (None, 1, "d"), (99, 1, "e")], "doc_id long, quality int, text string")
    got = score_quality(docs, labels).collect()
    assert sorted((x.doc_id or 0) for x in got) == [0, 1, 2, 3, 5, 5, 6, 7]
    assert len(keep_good(docs, labels).columns) == 4
    none = score_quality(docs, labels.limit(0)).collect()
    assert all(x.score == 0.5 and x.predicted == 1 for x in none)
    assert score_quality(docs.limit(0), labels).collect() == [] and keep_good(docs.limit(0), labels).collect() == []


def test_statistics_by_hand():
    s = dict(zip(STATS, statistics(pa.array(["Ab ab é!\nAb ab é!\nx.", None]))[0]))
    assert s["words"] == pytest.approx(np.log1p(7)) and s["lines"] == pytest.approx(np.log1p(3))
    assert s["distinct_lines"] == pytest.approx(2 / 3) and s["ended_lines"] == 1.0
    assert s["distinct_words"] == pytest.approx(3 / 7) and s["top_word"] == pytest.approx(4 / 7)
    assert (statistics(pa.array([None, ""])) == 0).all()


def test_rules_find_a_conjunction():
    x = np.random.default_rng(0).random((4000, len(STATS)))
    y = ((x[:, 2] > 0.6) & (x[:, 8] <= 0.5)).astype(float)
    model = fit_rules(x[:3000], y[:3000])
    z = np.full(1000, model.intercept)
    for rule, w in model.rules:
        hit = np.ones(1000, bool)
        for k, above, edge in rule:
            hit &= (x[3000:, k] > edge) == above
        z += w * hit
    assert np.mean((z > 0) == (y[3000:] > 0.5)) > 0.97
    assert len(model.rules) < 120
