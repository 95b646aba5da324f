"""op11: base scores by plain counting, recursions by summing over all state paths, held-out gain."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK, SF_SMALL
from vigia.llm import hmm
from vigia.llm.queries import hmm_language_model

SMALL = {"states": 3, "classes": 64, "rounds": 3}
HELD_SQL = "crc32(CAST(doc_id AS STRING)) % 7 = 2"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base_plain(rows):
    """(doc_id, held, n_tokens, n_known, N, base score) of each row, by counting words."""
    c = Counter()
    for i, text in rows:
        if not held(i):
            c.update([*words(text), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, text in rows:
        seq = [*words(text), None]
        out.append((i, held(i), len(seq), sum(c[w] > 0 for w in seq), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in seq)))
    return out, c


def forward_plain(seq, model, counts, classes):
    """log10 probability of a token sequence, token by token, without scaling across tokens."""
    n, v = model.tokens, model.types
    a, total = model.start, 0.0
    for w in seq:
        row = classes + 1 if not counts[w] else classes if w is None else zlib.crc32(w.encode()) % classes
        a = (a @ model.step) * model.lift[row] * (counts[w] + 1) / (n + v + 1)
        total += math.log10(a.sum())
        a = a / a.sum()
    return total


def fitted(docs, **how):
    how = SMALL | how
    blocks = hmm.blocks_of(docs, F.expr(HELD_SQL), how.pop("block_bytes", 2000), how["classes"])
    counts = hmm.word_counts(blocks, how["classes"])
    model = hmm.train(blocks, counts, **how)
    return model, hmm.score(blocks, counts, model, how["classes"], how.get("piece", hmm.SEGMENT)).collect()


EDGE = [(1, "The cat sat.\nthe  CAT"), (2, None), (3, ""), (None, "a b c"), (4, "ñandú Ñ É x \x0b y"), (4, "a b c"), (4, "a b c"), (15, "unseen thing here"),
        (6, "w " * 3000), (7, " \t\n "), (28, "z"), *[(k, f"the cat {k % 5} sat on the mat {k}") for k in range(30, 60)]]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.withColumn("block", F.lit("x")).withColumn("held", F.lit(1)).withColumn("WORDS", F.lit(None).cast("int"))


@pytest.mark.parametrize("piece", [7, hmm.SEGMENT])
def test_scores_against_plain_recursion(spark, piece):
    model, got = fitted(frame(spark, EDGE), piece=piece)
    want, counts = base_plain(EDGE)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[5], 6))
    got, order = sorted(map(tuple, got), key=key), sorted(range(len(want)), key=lambda k: key(want[k]))
    for g, k in zip(got, order, strict=True):
        assert g[:5] == want[k][:5] and g[5] == pytest.approx(want[k][5], abs=1e-8)
        assert g[6] == pytest.approx(forward_plain([*words(EDGE[k][1]), None], model, counts, 64), abs=1e-7)


def test_a_state_spreads_one_over_all_words(spark):
    model, _ = fitted(frame(spark, EDGE))
    _, counts = base_plain(EDGE)
    for s in range(3):
        known = sum(model.lift[64 if w is None else zlib.crc32(w.encode()) % 64, s] * (c + 1) for w, c in counts.items())
        assert (known + 1) / (model.tokens + model.types + 1) == pytest.approx(1)
    assert np.allclose(model.step.sum(axis=1), 1) and model.start.sum() == pytest.approx(1)


def paths(seq, lift, step, start):
    """Weight of every path of states, the silent first one included."""
    for path in itertools.product(range(len(step)), repeat=len(seq) + 1):
        weight = start[path[0]]
        for o, i, j in zip(seq, path, path[1:]):
            weight *= step[i, j] * lift[o, j]
        yield path, weight


@pytest.mark.parametrize("piece", [2, 100])
def test_recursions_sum_over_all_paths(piece):
    rng = np.random.default_rng(3)
    lift, step, start = rng.random((5, 3)) + 0.1, rng.random((3, 3)) + 0.1, rng.random(3)
    step, start = step / step.sum(axis=1, keepdims=True), start / start.sum()
    texts = [[0, 1, 2, 3, 4], [4], [1, 1], [2, 0, 3, 1]]
    flat, lengths = np.concatenate(texts).astype(np.uint16), np.array([len(t) for t in texts])
    emitted, pairs, starts = np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3)
    logs = []
    for t in texts:
        all_ = list(paths(t, lift, step, start))
        total = sum(w for _, w in all_)
        logs.append(math.log(total))
        for path, w in all_:
            starts[path[0]] += w / total
            for o, i, j in zip(t, path, path[1:]):
                emitted[o, j] += w / total
                pairs[i, j] += w / total
    assert np.allclose(hmm.log_likelihoods(flat, lengths, lift, step, start, piece), logs)
    got = hmm.expected_counts(flat, lengths, lift, step, start, piece)
    assert np.allclose(got[0], emitted) and np.allclose(got[1], pairs) and np.allclose(got[2], starts) and got[3] == pytest.approx(sum(logs))


def test_every_round_fits_better_and_held_out_texts_gain(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model, got = fitted(docs, states=hmm.STATES, classes=hmm.CLASSES, rounds=hmm.ROUNDS, block_bytes=hmm.BLOCK_BYTES)
    assert all(a < b for a, b in zip(model.log_likelihood, model.log_likelihood[1:]))
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + 0.1 * sum(r["n_tokens"] for r in out)


def test_one_state_is_the_base(spark):
    _, got = fitted(frame(spark, EDGE), states=1)
    assert all(r["score"] == pytest.approx(r["base_score"], abs=1e-5) for r in got)


def test_blocks_do_not_change_counts(spark):
    one, many = fitted(frame(spark, EDGE), block_bytes=1 << 20), fitted(frame(spark, EDGE), block_bytes=20)
    assert (one[0].tokens, one[0].types, one[0].ends) == (many[0].tokens, many[0].types, many[0].ends)
    assert sorted(round(r["base_score"], 6) for r in one[1]) == sorted(round(r["base_score"], 6) for r in many[1])


def test_nothing_to_learn_from(spark):
    assert fitted(frame(spark, [])[["doc_id", "text"]])[1] == []
    only_held = [i for i in range(100) if held(i)][:3]
    model, got = fitted(frame(spark, [(i, "a b") for i in only_held]))
    assert model.tokens == model.types == 0
    assert [tuple(r)[1:] for r in got] == [(True, 3, 0, 0, 0.0, 0.0)] * 3


def test_registered_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    want, _ = base_plain([tuple(r) for r in docs.collect()])
    got = {r["doc_id"]: tuple(r) for r in hmm_language_model(spark, SF_SMALL).collect()}
    for w in want:
        assert got[w[0]][:5] == w[:5] and got[w[0]][5] == pytest.approx(w[5], abs=1e-6) and math.isfinite(got[w[0]][6])
