"""Corpus pipeline: documents through five training-data operators, stage by stage.

Each stage takes what the one before it kept and returns the columns of ``documents`` (the last:
the digest of the files it wrote); its decisions take effect on the rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vigia.llm.common import table, written
from vigia.llm.decontaminate import drop_contaminated
from vigia.llm.mixing import mixed_documents
from vigia.llm.near_copies import one_of_each_class
from vigia.llm.quality import keep_good
from vigia.llm.token_ids import token_ids


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below 0.5 go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join stays."""
    return one_of_each_class(docs, n=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the entropy-balanced mix takes it."""
    return mixed_documents(docs, weights=(5, 2, 1), cap=3.0)


def output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row in patched frame-of-reference files, and their digest."""
    return token_ids(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", output),
]

#: Learnt rules, connected classes and tokenization are not SQL; tests/llm/test_pipeline.py holds
#: every stage against a plain version on the whole of a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps goes to shared storage and is read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
