"""Corpus pipeline: toxicity, near-duplicates, secrets, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpulse.llm import mixing, packing, secret_scan, simhash, toxicity
from leadpulse.llm.common import free_name, stage, table
from leadpulse.llm.registry import TOKENIZER


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return (toxicity.with_score(spark, docs, model, score).where(F.col(score) < 0.5)
            .select(*docs.columns))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicated(spark, docs)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that look live replaced by a mark."""
    return secret_scan.redacted(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mixed_documents(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences."""
    return packing.pack_documents(spark, docs, str(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_duplicates_out),
    ("secrets", secrets_out),
    ("mix", mix),
    ("pack", pack),
]

# The classifier, the fingerprints and the rounding have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
