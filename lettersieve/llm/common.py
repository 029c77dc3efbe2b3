"""What several operators share: tables, word counts, free column names, numbering."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# White space of the word pattern [^\x20\x09-\x0D]+ as a regular expression class.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
# At most this many values can hold more than a 1/HOT_SHARE part of all rows each.
HOT_SHARE = 10_000


def ships_its_code(module: str) -> None:
    """Functions of ``module`` go to Python workers as code: the package need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+ of a text; 0 for null and for blank texts."""
    trimmed = F.btrim(text, F.lit(BLANK_CHARACTERS))
    return (
        F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.lit(0))
        .otherwise(F.size(F.split(trimmed, BLANKS)))
        .cast("bigint")
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once per row, also where ``use`` has lambdas over it."""
    return F.transform(F.array(value), use)[0]


def row_hash(*columns: str) -> Column:
    """Names a row by its content; with the id beside it, rows that share it are equal."""
    return F.xxhash64(*columns)


def same_row(left: str, right: str, row: str, doc_id: str) -> Column:
    return (F.col(f"{left}.`{row}`") == F.col(f"{right}._row")) & F.col(f"{left}.`{doc_id}`").eqNullSafe(
        F.col(f"{right}._id")
    )


def without_rows(marked: DataFrame, gone: DataFrame, row: str, doc_id: str) -> DataFrame:
    """``marked`` without the rows named in ``gone(_row, _id)``.

    Only names are gathered, so whole rows move only if there are so many names that Spark
    does not broadcast them.
    """
    return marked.alias("l").join(gone.alias("r"), same_row("l", "r", row, doc_id), "left_anti")


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, cell: str) -> DataFrame:
    """Adds ``name``: the 1-based position by (``cell``, ``order``) in each group.

    ``cell`` is a column that splits a group into parts small enough to sort in one task.
    Rows are numbered inside their cell; the cells' sizes, one row per cell, are summed up
    in a second window. Rows that tie in all of ``order`` are equal for the caller.
    """
    inside = W.partitionBy(*group, cell).orderBy(*order)
    before = W.partitionBy(*group).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*group, cell)
        .agg(F.count("*").alias("_n"))
        .select(*group, cell, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        df.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [*group, cell])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )
