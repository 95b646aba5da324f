"""Strings that collide under every polynomial hash mod 2^64: no operator takes them for equal."""
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.test_suffix_dedup import brute as spans_brute
from tests.llm.test_suffix_dedup import run as spans
from vigia.llm.common import PRIME, PolyHash, RollHash, _times, words
from vigia.llm.line_dedup import line_dedup
from vigia.llm.near_copies import near_copies
from vigia.llm.token_ids import PieceEncoder, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


ONE, TWO = thue_morse(2048), thue_morse(2048, "b", "a")


def hashes(kind, *texts, **how):
    flat = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    return kind(flat, **how).of(ends - [len(t) for t in texts], ends).tolist()


def test_the_fixture_collides_mod_2_64_and_not_mod_the_prime():
    assert len(set(hashes(RollHash, ONE, TWO))) == 1
    for base in (PolyHash.BASE, PolyHash.BASE2):
        assert len(set(hashes(PolyHash, ONE, TWO, base=base))) == 2
        assert len(set(hashes(PolyHash, "x" + ONE, ONE, ONE[:-1], base=base))) == 3


def test_the_hash_is_the_polynomial_wherever_it_starts():
    rng = random.Random(2)
    body = bytes(rng.randrange(256) for _ in range(5000))
    job = PolyHash(np.frombuffer(body, np.uint8))
    spans_ = [(a, a + rng.randrange(1, 300)) for a in (rng.randrange(4700) for _ in range(50))]
    want = [sum((c + 1) * pow(PolyHash.BASE, i, PRIME) for i, c in enumerate(body[a:b])) % PRIME for a, b in spans_]
    assert job.of(*(np.array(x) for x in zip(*spans_))).tolist() == want
    big = np.array([PRIME - 1, 0, 1, PRIME - 2, 1 << 60], np.uint64)
    assert _times(big, big[::-1].copy()).tolist() == [int(a) * int(b) % PRIME for a, b in zip(big, big[::-1])]


def test_a_long_body_is_hashed_in_pieces():
    body = np.frombuffer(random.Random(3).randbytes(5 << 20), np.uint8)
    job, at = PolyHash(body), np.array([0, (1 << 21) - 7, (4 << 20) + 1])
    again = [int(PolyHash(body[a:a + 40]).of(np.array([0]), np.array([40]))[0]) for a in at]
    assert job.of(at, at + 40).tolist() == again


def test_words_and_pieces_are_told_apart(spark):
    h = words(pa.array([ONE, TWO, ONE]))[0]
    assert h[0] == h[2] != h[1]
    tok = Tokenizer.from_file(PATH)
    assert PieceEncoder.of(PATH).encode(pa.array([ONE + " " + TWO])) == [np.asarray(tok.encode(ONE + " " + TWO, add_special_tokens=False).ids, "<u4").tobytes()]
    rows = spark.createDataFrame([(1, ONE), (2, TWO), (3, ONE)], "doc_id long, text string")
    got = {r.doc_id: r.ids_crc32 for r in token_ids(rows, PATH, end_id=2).collect()}
    want = {i: zlib.crc32(np.asarray([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in ((1, ONE), (2, TWO), (3, ONE))}
    assert got == want


def test_another_tokenizer_is_refused(tmp_path):
    raw = open(PATH, encoding="utf-8").read()
    other = tmp_path / "other.json"
    assert '"lowercase"' in raw.lower() or "Lowercase" in raw
    other.write_text(raw.replace('"Lowercase"', '"NFC"', 1), encoding="utf-8")
    with pytest.raises(ValueError, match="does not cut"):
        PieceEncoder(str(other))


def test_lines_are_told_apart(spark):
    rows = [(1, f"{ONE}\n{ONE} x\nshared a\nshared b"), (2, f"{TWO}\n{TWO} x\nown"), (3, f"shared a\nshared b\n{TWO}")]
    got = {r.doc_id: r.kept for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_lines(rows)
    assert got[2] == rows[1][1] and got[3] == TWO


def plain_lines(rows):
    """Lines left by the rule of two: a pair that occurs earlier goes."""
    seen, out = set(), {}
    for i, text in rows:
        lines, gone = text.split("\n"), set()
        for k in range(len(lines) - 1):
            pair = lines[k], lines[k + 1]
            gone |= {k, k + 1} if pair in seen else set()
            seen.add(pair)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_texts_are_told_apart(spark):
    rows = spark.createDataFrame([(1, ONE), (2, TWO), (3, ONE), (4, f"{TWO} b c d e f"), (5, f"{ONE} b c d e f")], "doc_id long, text string")
    got = {r.doc_id: r for r in near_copies(rows).collect()}
    classes = {}
    for i, r in got.items():
        classes.setdefault(r["class_id"], set()).add(i)
    assert sorted(map(sorted, classes.values())) == [[1, 3], [2], [4], [5]]


@pytest.mark.parametrize("group", [2, 8192])
def test_spans_are_told_apart(spark, group):
    rows = [(1, ONE + "tail one"), (2, TWO + "tail two"), (3, "head " + ONE[300:900]), (4, "other " + TWO[300:900]), *[(10 + k, f"{k}" + ONE[5:260 + k]) for k in range(6)]]
    assert spans(spark, rows, group=group) == spans_brute(rows)

