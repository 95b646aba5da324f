import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from vigia.llm.suffix_dedup import SuffixSort, anchors, suffix_dedup


def brute(rows, length=200):
    body = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(hash(b[j:j + length]) for _, b in body for j in range(len(b) - length + 1))
    out = []
    for i, b in body:
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if seen[hash(b[j:j + length])] > 1:
                gone[j:j + length] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], "doc_id long, text string, h string, k int, anchor int")
    return sorted((tuple(r) for r in suffix_dedup(df.repartition(3), **kw).collect()), key=repr)


def _word(r):
    return "".join(r.choice("abcdeé") for _ in range(r.randint(2, 9)))


def _corpus(seed):
    r = random.Random(seed)
    text = lambda n: " ".join(_word(r) for _ in range(n))
    passage, long = text(60), text(900)
    rows = [(1, long), (2, long), (3, text(40) + passage + text(40)), (4, passage), (5, text(10) + passage[3:]),
            (6, None), (7, ""), (8, "x" * 199), (9, "a" * 700), (10, "ab" * 300), (11, long[:2000] + text(30) + long[2000:]),
            (None, passage), (None, passage), (12, text(30)), (12, text(50)), (13, long), (13, long)]
    rows += [(100 + i, text(3) + passage[:260 + i] + text(8)) for i in range(25)]
    return rows


@pytest.mark.parametrize("group", [1024, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, group):
    rows = _corpus(seed)
    assert run(spark, rows, group=group) == brute(rows)


def test_texts_beyond_one_slice(spark):
    r = random.Random(11)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(100, 60_000))) for _ in range(40)]
    rows = list(enumerate(texts)) + [(100 + i, t[50:900] + "#" + t[2000:2300]) for i, t in enumerate(texts)]
    assert run(spark, rows) == brute(rows)


def test_short_window_dense_repeats(spark):
    r = random.Random(5)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 120)))) for i in range(40)]
    assert run(spark, rows, length=12, gram=5) == brute(rows, 12)


def test_whole_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted((tuple(r) for r in suffix_dedup(docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert any(r[2] for r in got)


def test_empty_table(spark):
    assert suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_suffix_sort_orders_like_bytes():
    r = random.Random(7)
    body = np.frombuffer("".join(r.choice("ab") for _ in range(600)).encode(), np.uint8)
    start, bucket = np.arange(500), np.sort(np.asarray([r.randint(0, 6) for _ in range(500)]))
    order = SuffixSort(body, 40).sort(start, bucket)
    raw = body.tobytes()
    want = sorted(range(500), key=lambda i: (bucket[i], raw[i:i + 40], i))
    assert order.tolist() == want


def test_every_window_has_one_anchor_in_pieces(monkeypatch):
    import vigia.llm.suffix_dedup as m
    r = random.Random(3)
    body = np.frombuffer("".join(r.choice("abcd") for _ in range(5000)).encode(), np.uint8)
    offs = np.asarray([0, 100, 100, 2500, 5000])
    for piece in (8 << 20, 700):
        monkeypatch.setattr(m, "PIECE", piece)
        text, place, first, last, _, _ = anchors(body, offs, 200, 48)
        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
        assert sorted(starts) == [j for a, b in zip(offs, offs[1:]) for j in range(a, b - 199)]
        assert all(a <= p and p + 48 <= b + 200 and p >= b for p, a, b in zip(place, first, last))
