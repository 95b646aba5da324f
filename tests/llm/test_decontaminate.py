import random
import re

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from vigia.llm.decontaminate import _edit_distances, _walk, drop_contaminated, find_benchmark_passages


def tokens(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def best_distance(item, text):
    d = [0] * (len(text) + 1)
    for k, a in enumerate(item):
        new = [k + 1]
        for j, b in enumerate(text):
            new.append(min(d[j] + (a != b), d[j + 1] + 1, new[j] + 1))
        d = new
    return min(d)


def brute(docs, items, edits=0.2):
    out = []
    for i, t in docs:
        w = tokens(t)
        for k, u in items:
            m = tokens(u)
            if m:
                d = best_distance(m, w)
                if d <= int(edits * len(m)):
                    out.append((i, k, d, len(m)))
    return sorted(out)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, item_id int, distance string"),
            spark.createDataFrame([(k, u, "y") for k, u in items], "item_id long, text string, doc_id string"))


def _text(r, n, vocabulary=400):
    return " ".join(r.choice(["the", "of", f"w{r.randrange(vocabulary)}"]) + r.choice(["", "", ",", "."]) for _ in range(n))


def _edited(r, words, share):
    words = list(words)
    for _ in range(int(share * len(words))):
        at, kind = r.randrange(len(words)), r.randrange(3)
        if kind == 0:
            words[at] = "zz%d" % r.randrange(99)
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, "yy%d" % r.randrange(99))
    return words


def test_verbatim_short_cut_and_clashing_cases(spark):
    r = random.Random(1)
    items = [(k, _text(r, r.randint(14, 60))) for k in range(20)] + [(50, "alpha beta gamma"), (51, ""), (52, None), (7, "Alpha!")]
    docs = [(100 + k, _text(r, 40) + " " + u.upper().replace(" ", "\n") + " " + _text(r, 40)) for k, u in items[:20]]
    docs += [(1, None), (2, ""), (3, "x alpha BETA, gamma y"), (4, items[3][1]), (4, items[3][1]), (None, items[5][1]),
             (5, _text(r, 30_000) + " " + items[6][1]), (6, " ".join(items[2][1].split()[1:])), (8, "beta gamma"), (9, _text(r, 300))]
    d, b = frames(spark, docs, items + [items[0]])
    got = sorted((tuple(x)[:4] for x in find_benchmark_passages(d, b).collect()), key=repr)
    want = sorted(((None if i == -1 else i, *x) for i, *x in brute([(-1 if i is None else i, t) for i, t in docs], items)), key=repr)
    assert got == want
    bad = {x[0] for x in want}
    kept = drop_contaminated(d.repartition(2), b)
    assert kept.columns == d.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(i for i, _ in docs if i not in bad)
    assert find_benchmark_passages(d, b, block_bytes=300).count() == len(want)


@pytest.mark.parametrize("share", [0.1, 0.18])
def test_recall_of_edited_passages(spark, share):
    r = random.Random(2)
    items = [(k, _text(r, r.randint(14, 60), 5000)) for k in range(200)]
    docs = [(k, _text(r, 60, 5000) + " " + " ".join(_edited(r, tokens(u), share)) + " " + _text(r, 60, 5000)) for k, u in items]
    want = {(k, k) for k, u in items if brute([docs[k]], [(k, u)])}
    got = {tuple(x)[:2] for x in find_benchmark_passages(*frames(spark, docs, items)).collect()}
    assert all(brute([docs[d]], [items[k]]) for d, k in got)  # whatever is found is within the limit
    assert len(got & want) >= 0.98 * len(want) and len(want) >= 190


def test_small_table_against_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = {x[:2] for x in brute([(x.doc_id, x.text) for x in docs.collect() if len(x.text) < 12_000], [tuple(x) for x in bench.select("item_id", "text").collect()])}
    got = {tuple(x)[:2] for x in find_benchmark_passages(docs, bench).collect()}
    assert want and want <= got


def test_empty_tables(spark):
    d, b = frames(spark, [(1, "a b c")], [(1, "a b")])
    assert find_benchmark_passages(d.limit(0), b).collect() == []
    assert find_benchmark_passages(d, b.limit(0)).collect() == []
    assert [x.doc_id for x in drop_contaminated(d, b.limit(0)).collect()] == [1]


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 50, 300).astype(np.uint64)
    h[200:240] = h[20:60]
    keys = _walk(np.concatenate([h, np.zeros(40, np.uint64)]), 300, 99, np.asarray([0, 3, 9, 14]), np.arange(1, 5).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    assert (keys[20:45] == keys[200:225]).all()


def test_edit_distances():
    item = np.asarray([1, 2, 3, 4], np.uint64)
    there = np.asarray([[9, 1, 2, 3, 4, 9], [1, 3, 4, 9, 9, 9], [1, 2, 7, 3, 4, 9], [9, 9, 9, 9, 9, 9]], np.uint64)
    assert _edit_distances(item, there, np.ones((4, 6), bool)).tolist() == [0, 1, 1, 4]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 8, 10, 12])
def test_recall_of_short_items_at_their_limit(spark, n):
    r = random.Random(n)
    items = [(k, " ".join(f"i{k}x{j}" for j in range(n))) for k in range(300)]
    docs = []
    for k, u in items:
        w = u.split()
        for e in range(n // 5):
            at, kind = r.randrange(len(w)), r.randrange(3)
            w[at:at + (kind > 0)] = [f"e{k}x{e}"] * (kind < 2)
        docs.append((k, _text(r, 20, 5000) + " " + " ".join(w) + " " + _text(r, 20, 5000)))
    got = {tuple(x)[:2] for x in find_benchmark_passages(*frames(spark, docs, items)).collect()}
    assert got <= {(k, k) for k, _ in items}
    assert len(got) >= (0.98 if n >= 5 else 1) * len(items)
