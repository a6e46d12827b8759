"""From raw documents to token numbers: language, near-duplicates, personal data, mix, encoding.

Each stage works on all that the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import op1_pii, op5_mix, op7_simhash, op9_langid, op10_bpe
from tracewright.llm.common import discard, scratch, shared_folder, shuffles_removed, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; texts without letters, null ones included, go."""
    return op9_langid.keep_sure(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest doc_id; rows without doc_id stay."""
    return op7_simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; null text stays null."""
    return op1_pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in training order."""
    return op5_mix.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row; null or empty text has no tokens and an empty list."""
    path, pattern = op10_bpe.default_vocabulary()
    return op10_bpe.encode(docs, path, pattern).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: Classifier, fingerprints and encoding have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; of the tables between them only the last one stays."""
    docs = table(spark, sf_dir, "documents")
    folder, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}", None
    for name, stage in STAGES:
        with scratch(spark), shuffles_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            discard(spark, f"{folder}/{before}")
        docs, before = spark.read.parquet(f"{folder}/{name}"), name
    return docs
