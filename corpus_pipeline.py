"""Corpus pipeline: language, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettersieve.llm import language, mixing, packing, secret_scan, simhash_wide
from lettersieve.llm.common import table
from lettersieve.sources.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go."""
    return language.only_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash_wide.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; n_chars follows the text."""
    return secret_scan.redacted(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, length, bucket, boundary, batch, place) of every row."""
    return packing.digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

# SQL can express neither the trained models nor the iterations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
