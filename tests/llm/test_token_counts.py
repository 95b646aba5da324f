import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from vigia.llm.token_counts import LEAF, REDACTED, CountedText, PieceCounter, token_counts, with_redactions

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def counter():
    return PieceCounter.of(PATH, P.PATTERN)


TEXT = st.text(alphabet="ab  \n'st1!é", max_size=400) | st.text(max_size=60)


@given(TEXT, st.lists(st.tuples(st.integers(0, 400), st.integers(0, 40), TEXT.map(lambda t: t[:12])), max_size=6))
@settings(max_examples=300, deadline=None)
def test_edits_count_like_encoding_anew(counter, text, edits):
    doc, plain = CountedText(text, counter), text
    for start, size, new in edits:
        doc.edit(start, start + size, new)
        a = min(start, len(plain))
        plain = plain[:a] + new + plain[min(a + size, len(plain)) if start <= len(plain) else a:]
        assert doc.text == plain
        assert doc.n_tokens == len(counter.encoding.encode_ordinary(plain))
        assert doc.tree.chars[1] == len(plain)


def test_only_the_touched_stretch_is_encoded(counter):
    r = random.Random(1)
    text = " ".join("word%d" % r.randrange(999) for _ in range(20_000))
    doc = CountedText(text, counter)
    doc.tree
    assert all(doc.edit(at, at + 5, "xyz") < 3 * LEAF * 10 for at in range(1000, 100_000, 9_000))
    assert doc.n_tokens == len(counter.encoding.encode_ordinary(doc.text))


def test_edits_beside_white_space_at_every_leaf_border(counter):
    """Runs of white space laid over each border between leaves, and edits at every place around them."""
    wrong, n = 0, 0
    for run in ("\n\n", " \n", "\n ", "  ", "   ", "\n\n\n", " \t ", "\r\n"):
        for lead in range(LEAF - 3, LEAF + 2):
            text = " ".join("abcdefgh"[k % 8] for k in range(lead)) + run + "b" + " c" * (LEAF + 5)
            at = text.index(run)
            for start in range(at - 2, at + len(run) + 3):
                for size, new in ((1, ""), (2, ""), (0, "x"), (0, "\n"), (1, " "), (0, " y")):
                    doc = CountedText(text, counter)
                    doc.edit(start, start + size, new)
                    n += 1
                    wrong += doc.n_tokens != len(counter.encoding.encode_ordinary(text[:start] + new + text[start + size:]))
    assert wrong == 0 and n > 1000


def test_the_edit_that_frees_a_run_of_breaks(counter):
    text = " ".join("abcdefgh"[k % 8] for k in range(LEAF - 1)) + "\n\nb"
    doc = CountedText(text, counter)
    doc.edit(len(text) - 1, len(text), "")
    assert doc.n_tokens == len(counter.encoding.encode_ordinary(text[:-1]))


def test_whole_table_against_encoding(spark, counter):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in token_counts(with_redactions(docs), PATH, P.PATTERN).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        new = REDACTED.sub(lambda m: f"[{m.lastgroup}]", r.text)
        assert got[r.doc_id].n_tokens == len(counter.encoding.encode_ordinary(r.text))
        assert got[r.doc_id].n_tokens_after == len(counter.encoding.encode_ordinary(new))
        assert got[r.doc_id].n_edits == len(REDACTED.findall(r.text))
    assert any(g.n_edits for g in got.values())


def test_edge_rows(spark, counter):
    rows = [(1, None, [(0, 5, "ab")]), (2, "", None), (None, "x y", [(9, 3, None), None, (None, None, "q")]), (3, "a b", []), (3, "a b", []), (4, "z" * 300_000, [(5, 9, " ")])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>, n_tokens int")
    got = sorted((tuple(r)[:4] for r in token_counts(docs, PATH, P.PATTERN).collect()), key=repr)
    n = lambda t: len(counter.encoding.encode_ordinary(t))
    long = "z" * 300_000
    assert got == sorted([(1, 0, 1, n("ab")), (2, 0, 0, 0), (None, n("x y"), 3, n("qx y")), (3, 2, 0, 2), (3, 2, 0, 2),
                          (4, n(long), 1, n(long[:5] + " " + long[9:]))], key=repr)
    assert token_counts(docs.limit(0), PATH, P.PATTERN).collect() == []
