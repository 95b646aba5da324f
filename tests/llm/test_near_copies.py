import random
import re

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from vigia.llm.near_copies import bands_for, connected, near_copies, one_of_each_class


def grams(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, similarity=0.8):
    sets = [grams(t) for _, t in rows]
    links, group = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= similarity * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, least.get(root(i)), links[i]) for i, (d, _) in enumerate(rows)), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "n", 1, [2]) for i, t in rows], "doc_id long, text string, node string, band int, bands array<int>").repartition(3)


def corpus(seed):
    r = random.Random(seed)
    text = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    rows = []
    for c in range(12):
        base = text(r.choice([6, 30, 120, 400]))
        for _ in range(r.randint(1, 9)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 60))):
                w[r.randrange(len(w))] = "edit%d" % r.randrange(99)
            rows.append(" ".join(w) if r.random() < 0.7 else "  ".join(w).upper())
    rows += [None, "", "  \n", "one", "one", "One two", "a b c d e", "a b c d e", " ".join(text(25_000))]
    rows = [(7 * i % 211, t) for i, t in enumerate(rows)]
    return rows + [(None, rows[0][1]), (None, None), (None, "lonely text"), rows[1], rows[1]]


@pytest.mark.parametrize("seed,block", [(1, 256), (2, 2)])
def test_against_brute_force(spark, seed, block):
    rows = corpus(seed)
    got = sorted((tuple(r) for r in near_copies(frame(spark, rows), block=block).collect()), key=repr)
    assert got == brute(rows)


def test_rows_equal_in_id_and_text_link_once_each(spark):
    base = [f"w{i}" for i in range(60)]
    near = [" ".join(base), " ".join(base[:-1]), " ".join(base[:-2])]
    rows = [(1, near[0])] * 4 + [(2, near[1])] * 3 + [(3, near[2]), (None, near[2])] + [(9, "far away text of its own")] * 2
    assert sorted((tuple(r) for r in near_copies(frame(spark, rows)).collect()), key=repr) == brute(rows)


def test_one_row_of_each_class_stays(spark):
    rows = corpus(3)
    df = frame(spark, rows)
    kept = one_of_each_class(df).collect()
    classes = brute(rows)
    blank = sum(1 for _, t in rows if not grams(t))
    assert kept[0].__fields__ == df.columns
    assert sum(1 for r in kept if not grams(r.text)) == blank
    sets = [grams(r.text) for r in kept if grams(r.text)]
    assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    every = [grams(t) for _, t in rows if grams(t)]
    assert all(any(len(a & b) >= 0.8 * len(a | b) for b in sets) for a in every)  # this corpus has no chains
    assert len(sets) == len({c for d, c, _ in classes if c is not None and any(d == e and grams(t) for e, t in rows)}) + 1


def test_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted((tuple(r) for r in near_copies(docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_copies(df).collect() == [] and one_of_each_class(df).collect() == []


def test_bands_reach_the_recall():
    b = bands_for(0.8, 0.99999, 5)
    assert 1 - (1 - 0.8 ** 5) ** b >= 0.99999 > 1 - (1 - 0.8 ** 5) ** (b - 1)


def test_connected_long_path_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(i, 100) for i in range(90, 95)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame([((a, 0), (b, 0)) for a, b in edges], "x struct<a:long,b:long>, y struct<a:long,b:long>")
    got = {r.x.a: r.label.a for r in connected(df, "test").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 90 for i in list(range(90, 95)) + list(range(100, 131))}}


def test_connected_long_path_of_shuffled_ids(spark):
    ids = list(range(2000))
    random.Random(2).shuffle(ids)
    edges = [((a, 0), (b, 0)) for a, b in zip(ids, ids[1:])] + [((5000, 0), (5000, 0)), ((5001, 0), (5002, 0))]
    df = spark.createDataFrame(edges, "x struct<a:long,b:long>, y struct<a:long,b:long>")
    got = {r.x.a: r.label.a for r in connected(df, "test").collect()}
    assert got == {**{i: 0 for i in ids}, 5000: 5000, 5001: 5001, 5002: 5001}


def test_words_are_held_for_a_slice_of_a_tile_only(monkeypatch):
    """Texts of a tile may be long: their words are not all held at once, their n-gram sets are the same."""
    import numpy as np
    import pyarrow as pa

    from vigia.llm import near_copies as N

    texts = pa.array([" ".join(f"w{(i * 7 + j) % 50000}" for j in range(40_000)) for i in range(12)] + ["", "a b", "A  b c d e f"])
    h, first, _, _ = N.words(pa.compute.utf8_lower(texts))
    g, begin = N.ngrams(h, first, 5)
    want = [np.unique(g[a:b]) for a, b in zip(begin[:-1], begin[1:])]
    read, words = [], N.words
    monkeypatch.setattr(N, "words", lambda strings: read.append(strings.nbytes) or words(strings))
    got = N._gram_sets(texts, 5)
    assert len(got) == len(want) and all((a == b).all() for a, b in zip(got, want))
    assert max(read) < texts.nbytes / 2
