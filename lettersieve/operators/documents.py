"""From build events to documents, and what the documents look like as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettersieve.functions import text
from lettersieve.operators import slices

# The kinds of build events.
HEADER_KINDS = ("HDR", "MIME_HDR")
BODY_KIND = "BODY_PART"
BODY_FIELD = "body"


def join_chunks(events: DataFrame) -> DataFrame:
    """Whole events of events whose values come in pieces, numbered by ``chunk``.

    A value is one field of one document, so its pieces belong in one row. Empty pieces and
    empty values stay; null pieces add nothing.
    """
    keys = [c for c in events.columns if c not in ("chunk", "value")]
    pieces = F.array_sort(F.collect_list(F.struct("chunk", "value")))
    return events.groupBy(*keys).agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "").alias("value"))


def header_values(events: DataFrame) -> DataFrame:
    """(box, uid, seq, hdr_name, field, value) of main and MIME part headers alike."""
    return events.filter(F.col("key_type").isin(*HEADER_KINDS) & (F.col("hdr_name") != "")).select(
        "box", "uid", "seq", "hdr_name", text.field_name(F.col("hdr_name")).alias("field"), "value"
    )


def body_first_part(events: DataFrame) -> DataFrame:
    """(box, uid, body): a message's first body part, found before anything is shuffled."""
    return (
        events.filter(F.col("key_type") == BODY_KIND)
        .groupBy("box", "uid")
        .agg(text.clean_value(F.min_by("value", "seq")).alias("body"))
    )


def _occurrences(events: DataFrame) -> DataFrame:
    """(box, uid, field, seq, is_part, value) of headers and body parts."""
    is_part = F.col("key_type") == BODY_KIND
    is_header = F.col("key_type").isin(*HEADER_KINDS) & (F.col("hdr_name") != "")
    return events.filter(is_part | is_header).select(
        "box",
        "uid",
        F.when(is_part, BODY_FIELD).otherwise(text.field_name(F.col("hdr_name"))).alias("field"),
        "seq",
        is_part.alias("is_part"),
        "value",
    )


def _check_parts(parts: str) -> None:
    if parts not in ("first", "all"):
        raise ValueError(f"parts must be 'first' or 'all', not {parts!r}")


def field_values(events: DataFrame, parts: str = "first", bits: int = slices.SLICE_BITS) -> DataFrame:
    """Documents in long form: (box, uid, field, pos, value), repeated fields in arrival order.

    A message of any size is fine: it is never gathered in one task.
    """
    _check_parts(parts)
    is_part = F.col("is_part").cast("int")
    counted = slices.running_totals(
        _occurrences(events), ["box", "uid", "field"], "seq", {"n_headers": 1 - is_part, "n_parts": is_part}, bits
    )
    if parts == "first":
        counted = counted.filter("not is_part or n_parts = 1").withColumn("n_parts", F.least("n_parts", F.lit(1)))
    return counted.select(
        "box",
        "uid",
        "field",
        (F.col("n_headers") + F.col("n_parts")).alias("pos"),
        text.clean_value(F.col("value")).alias("value"),
    )


def assemble(events: DataFrame, parts: str = "first") -> DataFrame:
    """Documents as (box, uid, fields MAP<STRING, ARRAY<STRING>>), values cleaned.

    One message becomes one row, as it is one JSON document; to look at messages of any
    size use ``field_values``. Events are shuffled once, on the message.
    """
    _check_parts(parts)
    cleaned = text.clean_value(F.col("value")).alias("value")
    by_field = (
        _occurrences(events)
        .repartition("box", "uid")
        .groupBy("box", "uid", "field")
        .agg(
            F.array_sort(F.collect_list(F.struct("seq", "is_part", cleaned))).alias("found"),
            F.min(F.when(F.col("is_part"), F.col("seq"))).alias("first_part"),
        )
    )
    if parts == "first":
        found = F.filter("found", lambda x: ~x["is_part"] | (x["seq"] == F.col("first_part")))
        by_field = by_field.withColumn("found", found)
    return by_field.groupBy("box", "uid").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "found.value")))).alias("fields")
    )


def normalized_names(events: DataFrame) -> DataFrame:
    """(hdr_name, field, n_values): every raw header name and what it is indexed as."""
    return header_values(events).groupBy("hdr_name", "field").agg(F.count("*").alias("n_values"))


def changed_values(fields: DataFrame) -> DataFrame:
    """(field, n_values, n_changed, n_bytes_after): effect of cleaning the values."""
    cleaned = text.clean_value(F.col("value"))
    return fields.groupBy("field").agg(
        F.count("value").alias("n_values"),
        F.sum((cleaned != F.col("value")).cast("bigint")).alias("n_changed"),
        F.sum(F.octet_length(cleaned).cast("bigint")).alias("n_bytes_after"),
    )


def field_catalog(events: DataFrame) -> DataFrame:
    """(field, n_docs, n_occurrences, n_raw_names): the fields that documents have.

    There are few fields and each may be in every message, so distinct counts are taken in
    two grouped steps (per message, per raw name) and not by one group per field.
    """
    headers = header_values(events).select("field", "box", "uid")
    bodies = events.filter(F.col("key_type") == BODY_KIND).select("box", "uid").distinct()
    documents = (
        headers.unionByName(bodies.withColumn("field", F.lit(BODY_FIELD)))
        .groupBy("field", "box", "uid")
        .agg(F.count("*").alias("n"))
        .groupBy("field")
        .agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_occurrences"))
    )
    names = (
        header_values(events).select("field", "hdr_name").distinct().groupBy("field").agg(F.count("*").alias("n_raw"))
    )
    return documents.join(names, "field", "left").select(
        "field", "n_docs", "n_occurrences", F.coalesce("n_raw", F.lit(0)).cast("bigint").alias("n_raw_names")
    )
