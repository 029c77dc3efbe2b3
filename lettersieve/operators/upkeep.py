"""Keeping the index: actions, removals, progress per box, and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettersieve.operators import slices
from lettersieve.sources.shared import stored

KEY = ["box", "uid"]
# Slices of an audit hold up to 1,024 documents: small enough that a change costs few comparisons.
AUDIT_BITS = 10


def last_ops(ops: DataFrame) -> DataFrame:
    """The last action of each key by ``seq``, deletes included.

    A key with very many actions is reduced to one row per task before the shuffle.
    """
    payload = [name for name in ops.columns if name not in KEY]
    last = ops.groupBy(*KEY).agg(F.max_by(F.struct(*payload), "seq").alias("last"))
    return last.select(*KEY, "last.*").select(*ops.columns)


def apply_ops(ops: DataFrame) -> DataFrame:
    """Current documents after ``index`` (replace) and ``delete`` actions: the last action wins."""
    return last_ops(ops).filter("op = 'index'").drop("op")


def expunge(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """Documents without those whose (box, uid) is listed."""
    return documents.join(keys.select(*KEY), KEY, "left_anti")


def last_uid(boxes: DataFrame, checkpoints: DataFrame, index_keys: DataFrame) -> DataFrame:
    """(box, last_uid): the stored checkpoint, else the highest indexed uid, else 0."""
    highest = index_keys.groupBy("box").agg(F.max("uid").alias("max_uid"))
    return (
        boxes.select("box")
        .join(checkpoints, "box", "left")
        .join(highest, "box", "left")
        .select("box", F.coalesce("last_indexed_uid", "max_uid", F.lit(0)).cast("bigint").alias("last_uid"))
    )


def boxes_of(messages: DataFrame) -> DataFrame:
    """(box, max_uid) of every box that has messages."""
    return messages.groupBy("box").agg(F.max("uid").alias("max_uid"))


def index_backlog(
    messages: DataFrame, checkpoints: DataFrame, index_keys: DataFrame, columns: Sequence[str] = KEY
) -> DataFrame:
    """(box, uid), or other columns, of the messages above their box's last uid."""
    boxes = boxes_of(messages)
    marks = last_uid(boxes, checkpoints, index_keys).join(boxes, "box")
    # Boxes that are up to date need no join at all.
    behind = marks.filter("max_uid > last_uid")
    rows = slices.join_by_box(messages, behind, ["box"], "max_uid")
    return rows.filter("uid > last_uid").select(*columns)


def advance_checkpoints(checkpoints: DataFrame, indexed: DataFrame) -> DataFrame:
    """(box, last_indexed_uid) after a run that indexed the given keys.

    Write the result only after the run's index write has succeeded.
    """
    reached = indexed.groupBy("box").agg(F.max("uid").alias("reached"))
    return checkpoints.join(reached, "box", "full_outer").select(
        "box", F.greatest("last_indexed_uid", "reached").alias("last_indexed_uid")
    )


def rescan(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints reset, so that everything counts as not indexed."""
    return checkpoints.withColumn("last_indexed_uid", F.lit(0).cast("bigint"))


def index_gaps(messages: DataFrame, index_keys: DataFrame) -> DataFrame:
    """(box, uid, kind): messages missing from the index and index rows without a message.

    One full outer join finds both directions, so either side is shuffled once.
    """
    return (
        messages.select(*KEY, F.lit(True).alias("in_messages"))
        .join(index_keys.select(*KEY, F.lit(True).alias("in_index")), KEY, "full_outer")
        .filter("in_messages is null or in_index is null")
        .select(
            *KEY,
            F.when(F.col("in_index").isNull(), "missing_from_index").otherwise("missing_from_source").alias("kind"),
        )
    )


def document_hash(columns: Sequence[str]) -> Column:
    """128 bits of a document's number and named columns; null and empty values differ."""
    return F.md5(F.to_json(F.struct("uid", *columns), {"ignoreNullFields": "false"}))


def content_audit(source: DataFrame, indexed: DataFrame, columns: Sequence[str], bits: int = AUDIT_BITS) -> DataFrame:
    """(box, uid, kind) of documents that the index lacks (missing), has in other words (changed) or alone (stray).

    Both sides are rolled up to one row per box and slice of 2^bits uids: the number of documents and the sums
    of both halves of their hashes. Only documents of slices that differ are then compared by key, so equal
    boxes cost one aggregate of two narrow columns and no join of documents.
    """
    pair = [
        stored(side.select(*KEY, document_hash(columns).alias("hash"), F.shiftright("uid", bits).alias("slice")), "audit")
        for side in (source, indexed)
    ]

    def half(at: int) -> Column:
        return F.sum(F.conv(F.substring("hash", at, 16), 16, 10).cast("decimal(20,0)"))

    rolled = [
        side.groupBy("box", "slice").agg(F.count("*").alias("n"), half(1).alias("a"), half(17).alias("b")) for side in pair
    ]
    tagged = rolled[0].unionByName(rolled[1])
    # A slice is equal if both sides have it and all three numbers agree.
    differing = (
        tagged.groupBy("box", "slice")
        .agg(F.count("*").alias("sides"), *[(F.max(c) != F.min(c)).alias(f"other_{c}") for c in ("n", "a", "b")])
        .filter("sides < 2 or other_n or other_a or other_b")
        .select("box", "slice")
    )
    differing = stored(differing, "audit-slices")
    first, second = (
        side.join(differing, ["box", "slice"], "left_semi").select(*KEY, F.col("hash").alias(name))
        for side, name in zip(pair, ("wanted", "got"), strict=True)
    )
    kind = F.when(F.col("got").isNull(), "missing").when(F.col("wanted").isNull(), "stray").otherwise("changed")
    return first.join(second, KEY, "full_outer").filter("not (wanted <=> got)").select(*KEY, kind.alias("kind"))
