import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from vigia.llm.token_ids import PieceEncoder, Segment, pack_segment, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(PATH)


@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=400), min_size=1, max_size=4),
       st.sampled_from([50.0, 90.0, 100.0]))
@settings(max_examples=60, deadline=None)
def test_segment_round_trip(docs, percentile):
    ids = np.asarray([x for d in docs for x in d], "<u4")
    seg = Segment(pack_segment(ids, [len(d) for d in docs], percentile))
    assert seg.lengths.tolist() == [len(d) for d in docs]
    assert seg.ids(0, seg.n).tolist() == ids.tolist()
    if len(ids) > 3:
        assert seg.ids(1, len(ids) - 1).tolist() == ids[1:-1].tolist()


@given(st.text(max_size=80) | st.text(alphabet=" \n\t\r\v\f  a's=<>.,-2İß<|endoftext|>́é1٣", max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_encode_like_the_whole_text(tok, encoder, text):
    for got, t in zip(encoder.encode(pa.array([text, "x" + text, text + "\u0338'S 12"])), [text, "x" + text, text + "\u0338'S 12"]):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def _brute(rows, tok):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table_against_plain_encoding(spark, tok):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in token_ids(docs, PATH).collect())
    assert got == _brute(rows, tok)


def test_nulls_ties_long_texts_and_clashing_columns(spark, tok):
    rows = [(3, None), (None, "null id"), (1, ""), (2, "word " * 50_000), (7, "same"), (7, "same"), (9, "x" * 3000)]
    docs = spark.createDataFrame([(a, b, "t", 1, 2) for a, b in rows], "doc_id long, text string, h string, part int, seq int")
    got = sorted((tuple(r) for r in token_ids(docs.repartition(3), PATH).collect()), key=lambda r: r[1])
    assert got == _brute(rows, tok)


def test_empty_table(spark):
    assert token_ids(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
