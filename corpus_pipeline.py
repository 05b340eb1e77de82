"""Corpus pipeline: five stages over ``documents``, each one of the operators
of ``spindle.llm``. A stage takes (spark, docs, sf_dir) and returns the rows it
keeps with the columns of documents; the last returns the encoded corpus. Each
stage's result is written as Parquet and read again as the next one's input.

A stage decides on the rows that its predecessor kept. Rows with null ids or
texts pass as the operators define: a null text counts as empty, an id is
compared null-safe, and such rows are kept unless an equal text precedes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindle.llm import decontaminate, exact_dedup, order_minhash, queries, toxic_crf
from spindle.llm.queries import table
from spindle.llm.runtime import drop_path, fresh_path, scratch_removed


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic CRF (8): rows that score ``TOXIC_LIMIT`` or more go. Learnt from the labelled rows of this input that are not held out."""
    return toxic_crf.reject(spark, docs, queries.toxic_field(spark, docs, table(spark, sf_dir, "labels")), queries.TOXIC_LIMIT)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Streaming exact dedup (2): of equal texts the smallest doc_id stays."""
    return exact_dedup.keep_first(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Order MinHash (1): of each near-duplicate group the smallest doc_id stays."""
    return order_minhash.keep_one(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix arrays (3): documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE (5): ids of every kept text and the digests of ids and decoded text."""
    return queries.encoded_and_decoded(spark, docs, with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_round_trip", bpe_round_trip),
]

#: Models, streaming state and tokenizer files cannot be expressed in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage wrote on its way, and the result
    of the stage before it, go once its own result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"pipeline-{k}-{name}")
        with scratch_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
