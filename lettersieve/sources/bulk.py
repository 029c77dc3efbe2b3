"""Actions as newline-delimited JSON, in batches of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettersieve.functions.text import clean_value
from lettersieve.operators import slices

# Fixed values of the exchange format.
BATCH_BYTES = 5_000_000
DOCUMENT_TYPE = "mail"


def action_line() -> Column:
    """``{"index" or "delete": {"_index": box, "_type": "mail", "_id": uid}}``"""
    target = F.struct(
        F.col("box").alias("_index"), F.lit(DOCUMENT_TYPE).alias("_type"), F.col("uid").alias("_id")
    )
    return F.to_json(F.create_map(F.col("op"), target))


def document_line(fields: Sequence[str]) -> Column:
    """The document with uid and box first, then the given columns, cleaned."""
    cleaned = [clean_value(F.col(name)).alias(name) for name in fields]
    return F.to_json(F.struct("uid", "box", *cleaned))


def document_line_of_map() -> Column:
    """As ``document_line``, for documents with a ``fields`` map of repeated values."""
    head = F.to_json(F.struct("uid", "box"))
    tail = F.to_json("fields")
    empty = F.size("fields") == 0
    return F.when(empty, head).otherwise(F.concat(F.rtrim(head, F.lit("}")), F.lit(","), F.ltrim(tail, F.lit("{"))))


def export_lines(ops: DataFrame, document: Column) -> DataFrame:
    """(box, uid, seq, lines): an action line and, unless it is a delete, a document line."""
    lines = F.when(F.col("op") == "delete", action_line()).otherwise(
        F.concat_ws("\n", action_line(), document)
    )
    return ops.select("box", "uid", "seq", lines.alias("lines"))


def value_bytes(columns: Sequence[str]) -> Column:
    """Raw bytes of the values of a document."""
    total = F.lit(0).cast("bigint")
    for name in columns:
        total = total + F.coalesce(F.octet_length(name), F.lit(0))
    return total


def assign_batches(sizes: DataFrame, limit: int = BATCH_BYTES, order: str = "uid", bits: int = slices.SLICE_BITS) -> DataFrame:
    """Adds ``batch`` to (box, uid, bytes), in the order of ``order``, unique in its box.

    A document goes to the batch in which the bytes before it in its box fall. So a batch
    without its last document never exceeds the limit, and no document is split.
    """
    summed = slices.running_totals(sizes, ["box"], order, {"_upto": F.col("bytes")}, bits)
    before = F.col("_upto") - F.col("bytes")
    return summed.withColumn("batch", F.floor(before / F.lit(limit)).cast("bigint")).drop("_upto")


EXPORT_BUCKETS = 256


def map_bytes() -> Column:
    """Raw bytes of the values of a document with a ``fields`` map."""
    sizes = F.transform(F.flatten(F.map_values("fields")), lambda v: F.coalesce(F.octet_length(v), F.lit(0)))
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, size: total + size)


def export_batches(documents: DataFrame, limit: int = BATCH_BYTES, bits: int = slices.SLICE_BITS) -> DataFrame:
    """(box, uid, batch, lines) of documents (box, uid, fields): the lines to send, by batch."""
    lines = F.concat_ws("\n", action_line(), document_line_of_map())
    sized = documents.withColumn("op", F.lit("index")).select("box", "uid", lines.alias("lines"), map_bytes().alias("bytes"))
    return assign_batches(sized, limit, bits=bits).select("box", "uid", "batch", "lines")


def write_export(lines: DataFrame, path: str, buckets: int = EXPORT_BUCKETS) -> None:
    """Writes (box, uid, batch, lines) in a bounded number of folders.

    Rows of a batch are next to each other in one file, in order. Batches are bounded, so
    shuffling by batch is even although boxes are not.
    """
    (
        lines.select("box", "batch", "uid", "lines")
        .withColumn("bucket", F.pmod(F.xxhash64("box", "batch"), F.lit(buckets)).cast("int"))
        .repartition("bucket", "box", "batch")
        .sortWithinPartitions("bucket", "box", "batch", "uid")
        .write.partitionBy("bucket")
        .parquet(path)
    )


def read_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("box string, batch bigint, uid bigint, lines string").parquet(path)


def write_text(lines: DataFrame, path: str, buckets: int = EXPORT_BUCKETS) -> None:
    """Writes (box, uid, batch, lines) as text files of JSON lines, ready to be sent.

    As in ``write_export`` the lines of a batch follow each other in one file of one folder.
    """
    (
        lines.select("box", "batch", "uid", "lines")
        .withColumn("bucket", F.pmod(F.xxhash64("box", "batch"), F.lit(buckets)).cast("int"))
        .repartition("bucket", "box", "batch")
        .sortWithinPartitions("bucket", "box", "batch", "uid")
        .select("bucket", F.col("lines").alias("value"))
        .write.partitionBy("bucket")
        .option("lineSep", "\n")
        .text(path)
    )


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(line): action and document lines of exported text files, one row each."""
    schema = "value string, bucket int"
    return spark.read.schema(schema).option("lineSep", "\n").text(path).select(F.col("value").alias("line"))
