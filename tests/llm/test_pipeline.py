from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from tests.conftest import SF_CHECK
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_near_copies import grams
from tests.llm.test_token_ids import _brute as encoded
from vigia.llm.common import table, written
from vigia.llm.mixing import mix_sources
from vigia.llm.quality import score_quality


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF_CHECK, "documents")
    out = [docs]
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, SF_CHECK), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stages_keep_the_columns(stages):
    assert len(P.STAGES) == 5
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_rejects_what_the_classifier_rejects(spark, stages):
    good = {r.doc_id for r in score_quality(stages[0], table(spark, SF_CHECK, "labels")).collect() if r.predicted}
    assert rows(stages[1]) == [r for r in rows(stages[0]) if r[0] in good]


def test_one_of_each_class_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert set(after) <= set(before)
    sets = {r[0]: grams(r[1]) for r in before}
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-9
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and near(a, b):
                group[max(root(i), root(j))] = min(root(i), root(j))
    assert [r[0] for r in after] == [i for i in ids if root(i) == i]


def test_contaminated_documents_go(spark, stages):
    before = rows(stages[2])
    items = [tuple(r) for r in table(spark, SF_CHECK, "benchmark").select("item_id", "text").collect()]
    shared = {w for _, t in items for w in zip(*[t.split()[k:] for k in range(3)])}
    # three words in a row survive any edits within the limit (items have at least 14 words)
    suspects = [r for r in before if shared & set(zip(*[r[1].split()[k:] for k in range(3)]))]
    assert min(len(t.split()) for _, t in items) >= 14
    bad = {x[0] for x in contaminated([(r[0], r[1]) for r in suspects if len(r[1]) < 15_000], items)}
    kept = {r[0] for r in rows(stages[3])}
    assert bad and not bad & kept
    assert kept >= {r[0] for r in before if len(r[1]) < 15_000} - bad


def test_mix_repeats_documents(stages):
    want = {r.doc_id: r.copies for r in mix_sources(stages[3]).collect() if r.copies}
    assert Counter(r.doc_id for r in stages[4].collect()) == want


def test_token_files(stages):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert rows(stages[5]) == encoded([(r[0], r[1]) for r in rows(stages[4])], tok)


def test_registered_queries(spark):
    names = set(E.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def corpus_of(spark, path, docs):
    """A folder with ``docs`` as its documents and the given labels and benchmark."""
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF_CHECK, name).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def edge_documents(spark):
    given = table(spark, SF_CHECK, "documents")
    shape = given.schema
    odd = [(10 ** 9, None, "en", "src0", 0), (10 ** 9 + 1, "", None, None, None), (None, "A text without an id, of some words that nobody else has written here.", "en", None, 70),
           (None, None, None, None, None), (10 ** 9 + 2, "word " * 30_000, "en", "src1", 150_000), (10 ** 9 + 3, " \t\n ", "xx", "src0", 4)]
    more = spark.createDataFrame([*odd, *odd[2:3], *odd[3:4]], shape)
    return given.unionByName(more).unionByName(given.limit(30))


def test_the_whole_pipeline_on_nulls_and_repeated_rows(spark, tmp_path):
    docs = edge_documents(spark)
    clash = docs.withColumn("score", docs.n_chars.cast("string")).withColumn("size", docs.doc_id).withColumn("k", docs.lang).withColumn("copies", docs.source).withColumn("Row", docs.doc_id)
    plain, wide = corpus_of(spark, tmp_path / "plain", docs), corpus_of(spark, tmp_path / "wide", clash)
    got = [tuple(r) for r in P.run(spark, plain).collect()]
    kept = table(spark, plain, "documents")
    for name, stage in P.STAGES[:-1]:
        before = kept.count()
        kept = written(stage(spark, kept, plain), f"edge-{name}")
        assert kept.columns == docs.columns and (name == "mixing" or kept.count() <= before)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = Counter((r["doc_id"], len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in kept.select("doc_id", "text").collect())
    assert Counter((r[0], r[2]) for r in got) == sizes and len(got) > 300
    starts = sorted((r[1], r[2]) for r in got)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    # further columns, whatever their names, ride along and change nothing
    stage = written(P.STAGES[0][1](spark, table(spark, wide, "documents"), wide), "edge-wide")
    for name, fn in P.STAGES[1:4]:
        stage = written(fn(spark, stage, wide), f"edge-wide-{name}")
    assert stage.columns == clash.columns
    assert Counter(r["doc_id"] for r in stage.select("doc_id").collect()) == Counter(r["doc_id"] for r in kept.select("doc_id").collect())


def test_the_whole_pipeline_on_an_empty_table(spark, tmp_path):
    path = corpus_of(spark, tmp_path / "empty", table(spark, SF_CHECK, "documents").limit(0))
    out = P.run(spark, path)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.collect() == []
