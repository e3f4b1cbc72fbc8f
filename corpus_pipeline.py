"""A training corpus from `documents`, stage by stage; each stage works on what the one before it kept.

Every stage but the last returns the columns of `documents`. Stages are written as
Parquet in the shared folder and read again, so a lost executor costs one stage's
tasks at most. Empty tables pass through; NULL texts have no words and go at the
first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firstmile.llm import bpe, columns, decontam, pii, quality, queries, simhash, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`."""
    return decontam.remove_leaks(docs, columns.table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token ids."""
    return bpe.tokenize(docs, queries.tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", redaction),
    ("bpe", tokens),
]

#: Fingerprints, BM25 retrieval and BPE merges are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, store.land(stage(spark, docs, sf_dir), f"stage-{name}")
        if name != STAGES[0][0]:
            store.drop(before)
    return docs
