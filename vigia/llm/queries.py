"""The registered training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigia.llm.common import table


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from vigia.llm.token_ids import token_ids
    return token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.suffix_dedup import suffix_dedup as run
    return run(table(spark, sf_dir, "documents"), length=200)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.decontaminate import find_benchmark_passages
    return find_benchmark_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.mixing import mix_sources
    return mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3.0)


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.near_copies import near_copies
    return near_copies(table(spark, sf_dir, "documents"), n=5, similarity=0.8)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.quality import score_quality
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.toxicity import score_toxicity
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after the edits that redact personal data in it."""
    import public_tokenizers

    from vigia.llm.token_counts import token_counts, with_redactions
    return token_counts(with_redactions(table(spark, sf_dir, "documents")),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.line_dedup import line_dedup as run
    return run(table(spark, sf_dir, "documents"), min_lines=2).drop("kept")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.posting_lists import nearest
    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.merkle import merkle_manifest as run
    return run(table(spark, sf_dir, "documents"))


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigia.llm.prefix_trie import shared_head_trie
    return shared_head_trie(table(spark, sf_dir, "conversations"))


def hmm_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose crc32(doc_id) mod 7 is not 2, scores all."""
    from pyspark.sql import functions as F

    from vigia.llm.hmm import hmm_scores
    return hmm_scores(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


QUERIES = {
    "op1_token_counts": edited_token_counts,
    "op3_toxicity": toxicity,
    "op6_line_dedup": line_dedup,
    "op8_nearest_vectors": nearest_vectors,
    "op9_quality": quality,
    "op4_source_mix": source_mix,
    "op10_jaccard_join": jaccard_join,
    "op2_suffix_dedup": suffix_dedup,
    "op5_decontamination": decontamination,
    "op7_token_ids": token_id_files,
    "op11_hmm_scores": hmm_language_model,
    "op12_merkle_manifest": merkle_manifest,
    "op13_prefix_trie": prefix_trie,
}

def _oracles() -> dict[str, str]:
    from vigia.llm import line_dedup, merkle, prefix_trie
    return {"op6_line_dedup": line_dedup.ORACLE_SQL, "op12_merkle_manifest": merkle.ORACLE_SQL, "op13_prefix_trie": prefix_trie.ORACLE_SQL}


ORACLES = _oracles()
