"""Merkle fixity audit of archive replicas.

A record is hashed over its bytes. Hashes are gathered into trees over ordered offset ranges: a
leaf node holds the records that begin in one range of ``2**RANGE_BITS`` bytes of an
archive, every level above joins ``2**STEP_BITS`` neighbours, and above the archives' roots
the archives are joined in the same way up to one root. Two replicas are compared from the
root down: at each level only the children of nodes that differ are read, and only the
records of the ranges that differ are compared one by one.

A replica is a table of records (archive, offset, record bytes). Only hashes and offsets are
shuffled, never the records. A node has at most ``2**STEP_BITS`` children; a leaf has at most as
many records as fit into its range, since a record has a header. Levels are tables in the
shared folder, so an audit can be repeated against a stored tree.

Defined results: equal replicas and empty tables give no rows. A record that only one replica
has is ``missing`` or ``extra``. Records that share archive and offset are compared as a
set of hashes. Null fields count as empty; a null archive is a number of its own (-1).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lettersieve.sources.shared import stored

RANGE_BITS = 14
STEP_BITS = 4
PER_ARCHIVE = 256


def record(url: Column, body: Column) -> Column:
    """The bytes of a resource record: header fields, blank line, body, two line ends."""
    text = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(text).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, text, F.lit("\r\n\r\n"))


def hashed(rows: DataFrame, record_id: str, url: str, body: str, archive: Column) -> DataFrame:
    """(archive, record_id, length, hash) of each row as a record."""
    whole = record(F.col(url), F.col(body))
    return rows.select(
        F.coalesce(archive.cast("bigint"), F.lit(-1)).alias("archive"),
        F.col(record_id).alias("record_id"),
        F.octet_length(whole).cast("bigint").alias("length"),
        F.sha2(whole, 256).alias("hash"),
    )


def placed(records: DataFrame) -> DataFrame:
    """Adds ``offset``: records follow each other in their archive by id, then hash.

    An archive has a bounded number of records by its definition, so its window is bounded.
    """
    order = W.partitionBy("archive").orderBy("record_id", "hash").rowsBetween(W.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))


@dataclass(frozen=True)
class Level:
    """Nodes (archive >> archive_bits, offset >> offset_bits); offset_bits None joins all offsets."""

    archive_bits: int
    offset_bits: int | None

    def names(self) -> tuple[Column, Column]:
        part = F.lit(0).cast("bigint") if self.offset_bits is None else F.shiftright("offset", self.offset_bits)
        return F.shiftright("archive", self.archive_bits), part


def levels(last_archive: int, last_offset: int) -> list[Level]:
    """From the leaves up to a level with one node for the archives from -1 on."""
    bits = RANGE_BITS
    found = [Level(0, bits)]
    while last_offset >> bits:
        bits += STEP_BITS
        found.append(Level(0, bits if last_offset >> bits else None))
    up = 0
    while (last_archive + 1) >> up:
        up += STEP_BITS
        found.append(Level(up, None))
    return found


def _node(level: Level, below: DataFrame) -> DataFrame:
    """(archive, offset, hash): hashes of the nodes of a level from the one below, in order."""
    archive, part = level.names()
    members = F.sort_array(F.collect_list(F.struct("archive", "offset", "hash")))
    return (
        below.select(archive.alias("node_archive"), part.alias("node_offset"), "archive", "offset", "hash")
        .groupBy("node_archive", "node_offset")
        .agg(
            F.sha2(
                F.array_join(F.transform(members, lambda m: F.concat_ws(":", m["archive"], m["offset"], m["hash"])), ","),
                256,
            ).alias("hash")
        )
        .select(F.col("node_archive").alias("archive"), F.col("node_offset").alias("offset"), "hash")
    )


def tree(records: DataFrame, plan: list[Level]) -> list[DataFrame]:
    """The stored levels of a replica's tree, leaves first.

    Names of nodes are those of the level, so a parent's name follows from a child's.
    """
    found: list[DataFrame] = []
    at = records.select(F.col("archive") + 1, "offset", "hash").toDF("archive", "offset", "hash")
    done = Level(0, 0)
    for level in plan:
        step = _relative(done, level)
        at = stored(_node(step, at), "merkle")
        found.append(at)
        done = level
    return found


def _relative(done: Level, level: Level) -> Level:
    """The shift that leads from the names of one level to those of the next."""
    bits = None if level.offset_bits is None or done.offset_bits is None else level.offset_bits - done.offset_bits
    return Level(level.archive_bits - done.archive_bits, bits)


def audit(good: DataFrame, other: DataFrame) -> DataFrame:
    """(archive, offset, record_id, length, expected, found, status) of records that differ.

    ``good`` and ``other`` have (archive, offset, record_id, length, hash).
    """
    good, other = stored(good, "replica"), stored(other, "replica")
    ends = (
        good.select("archive", "offset")
        .union(other.select("archive", "offset"))
        .agg(F.coalesce(F.max("archive"), F.lit(0)), F.coalesce(F.max("offset"), F.lit(0)))
        .first()
    )
    plan = levels(ends[0] + 1, ends[1])
    left, right = tree(good, plan), tree(other, plan)
    bad: DataFrame | None = None
    for depth in range(len(plan) - 1, -1, -1):
        a, b = left[depth], right[depth]
        if bad is not None:
            up = _relative(plan[depth], plan[depth + 1])
            a, b = (_children(nodes, up, bad) for nodes in (a, b))
        bad = stored(
            a.withColumnRenamed("hash", "expected")
            .join(b.withColumnRenamed("hash", "found"), ["archive", "offset"], "full")
            .filter(~F.col("expected").eqNullSafe(F.col("found")))
            .select("archive", "offset"),
            "mismatch",
        )
        if bad.isEmpty():
            break
    names = ["archive", "offset", "record_id", "length", "hash"]
    leaf = Level(0, plan[0].offset_bits)

    def suspects(rows: DataFrame) -> DataFrame:
        moved = rows.select((F.col("archive") + 1).alias("archive"), *names[1:])
        return _children(moved, leaf, bad)

    same = ["archive", "offset", "record_id", "length", "hash"]
    expected = suspects(good).groupBy(*same).agg(F.count("*").alias("_n"))
    found = suspects(other).groupBy(*same).agg(F.count("*").alias("_m"))
    differs = (
        expected.alias("e")
        .join(
            found.alias("f"),
            (F.col("e.archive") == F.col("f.archive"))
            & (F.col("e.offset") == F.col("f.offset"))
            & F.col("e.record_id").eqNullSafe(F.col("f.record_id")),
            "full",
        )
        .filter(~F.col("e.hash").eqNullSafe(F.col("f.hash")) | ~F.col("_n").eqNullSafe(F.col("_m")))
    )
    status = F.when(F.col("f.hash").isNull(), "missing").when(F.col("e.hash").isNull(), "extra").otherwise("changed")
    return differs.select(
        (F.coalesce("e.archive", "f.archive") - 1).alias("archive"),
        F.coalesce("e.offset", "f.offset").alias("offset"),
        F.coalesce("e.record_id", "f.record_id").alias("record_id"),
        F.coalesce("e.length", "f.length").alias("length"),
        F.col("e.hash").alias("expected"),
        F.col("f.hash").alias("found"),
        status.alias("status"),
    )


def _children(nodes: DataFrame, up: Level, bad: DataFrame) -> DataFrame:
    """The nodes (or records) whose parent is among ``bad``."""
    archive, part = up.names()
    parents = bad.select(F.col("archive").alias("_archive"), F.col("offset").alias("_offset"))
    return (
        nodes.withColumns({"_archive": archive, "_offset": part})
        .join(parents, ["_archive", "_offset"], "left_semi")
        .drop("_archive", "_offset")
    )


def archive_of(page_id: str) -> Column:
    return F.floor(F.col(page_id) / PER_ARCHIVE).cast("bigint")


def damaged(pages: DataFrame) -> DataFrame:
    """A second replica of ``pages`` as a failing store might leave it.

    The rows are those of the first replica, with faults by id: some bodies have a letter
    changed, some are cut to half, and some records are lost.
    """
    number = F.col("page_id")
    body = (
        F.when(number % 101 == 7, F.concat(F.lit("~"), F.expr("substring(html, 2)")))
        .when(number % 211 == 3, F.expr("substring(html, 1, length(html) div 2)"))
        .otherwise(F.col("html"))
    )
    return pages.withColumn("html", body).filter(F.coalesce(number % 307 != 5, F.lit(True)))


def digest(pages: DataFrame) -> DataFrame:
    """Audits a damaged replica of ``pages`` against the layout of the first one.

    A record that is lost has an empty hash.

    The layout (archive, offset, length) is the manifest of the first replica; the second
    replica's records are looked up at the offsets that the manifest gives them.
    """
    columns = ("page_id", "url", "html", archive_of("page_id"))
    turn = F.row_number().over(W.partitionBy("archive", "record_id").orderBy("hash"))
    good = stored(placed(hashed(pages, *columns)).withColumn("turn", turn), "manifest")
    other = hashed(damaged(pages), *columns).withColumn("turn", turn).drop("length")
    found = other.alias("o").join(
        good.alias("g"),
        (F.col("o.archive") == F.col("g.archive"))
        & F.col("o.record_id").eqNullSafe(F.col("g.record_id"))
        & (F.col("o.turn") == F.col("g.turn")),
    )
    names = ("archive", "offset", "record_id", "length")
    other = found.select(*[f"g.{name}" for name in names], "o.hash")
    return audit(good.drop("turn"), other).withColumnRenamed("record_id", "page_id").fillna("", ["expected", "found"])


# The damaged records, found by comparing every record.
ORACLE = """
WITH bodies AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         CASE WHEN page_id % 101 = 7 THEN '~' || substr(html, 2)
              WHEN page_id % 211 = 3 THEN substr(html, 1, CAST(length(html) // 2 AS BIGINT))
              ELSE html END AS other
  FROM pages
), records AS (
  SELECT page_id, CAST(floor(page_id / 256.0) AS BIGINT) AS archive,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
           || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
           || html || chr(13) || chr(10) || chr(13) || chr(10) AS good,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
           || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(other, '')) || chr(13) || chr(10) || chr(13)
           || chr(10) || coalesce(other, '') || chr(13) || chr(10) || chr(13) || chr(10) AS bad
  FROM bodies
), laid AS (
  SELECT *, strlen(good) AS length,
         sum(strlen(good)) OVER (PARTITION BY archive ORDER BY page_id) - strlen(good) AS "offset"
  FROM records
)
SELECT archive, CAST("offset" AS BIGINT) AS "offset", page_id, CAST(length AS BIGINT) AS length,
       sha256(good) AS expected,
       CASE WHEN page_id % 307 = 5 THEN '' ELSE sha256(bad) END AS found,
       CASE WHEN page_id % 307 = 5 THEN 'missing' ELSE 'changed' END AS status
FROM laid
WHERE page_id % 307 = 5 OR good <> bad
"""
