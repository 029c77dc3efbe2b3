"""The stored index of a set of given tables: built once, searched by many queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lettersieve.operators.postings import Index
from lettersieve.sources import index_tables, shared, tables

_built: dict[tuple, tuple[str, int]] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    # What the source files look like now: an index of an earlier state is not used again.
    # One row per file: names, sizes and times are listed, no file is read.
    files = spark.read.format("binaryFile").load(f"{sf_dir}/documents.parquet")
    file = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    seen = files.select(file.alias("file")).agg(F.count("*"), F.sum("file")).first()
    return (spark.sparkContext.applicationId, shared.shared_folder(spark), sf_dir, seen[0], str(seen[1]))


def open_index(spark: SparkSession, sf_dir: str) -> Index:
    """The index over the messages, from the shared folder; built there on first use."""
    state = _state(spark, sf_dir)
    if state not in _built:
        root = build_index(spark, sf_dir)
        _built[state] = (root, index_tables.read_layout(spark, root))
    return index_tables.read_index(spark, *_built[state])


def build_index(spark: SparkSession, sf_dir: str) -> str:
    root = shared.new_folder(spark, "index")
    index_tables.write_index(tables.message_documents(spark, sf_dir), root)
    return root
