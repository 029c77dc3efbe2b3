"""Skew-proof building blocks.

One mailbox may hold a third of all messages, so nothing here puts a whole mailbox in one
task. A *slice* is a run of 2**SLICE_BITS consecutive ids inside a group; ids are unique in
their group, so a slice never holds more rows than that however large the group is. Uids
are 32 bit, so a mailbox has at most 4,096 slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SLICE_BITS = 20
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
SALTS = 64


def bits_for(df: DataFrame, order: str, rows: int = 1 << SLICE_BITS) -> int:
    """The slice width that puts about ``rows`` rows in a slice, for ids with gaps between them.

    Ids that are dense in their group get the usual width; sparse ones, such as ids that many
    groups share, a wider one, so that slices do not outnumber what one task can sum up.
    """
    low, high, n = df.agg(F.min(order), F.max(order), F.count("*")).first()
    if not n:
        return SLICE_BITS
    spread = max(1, (int(high) - int(low) + 1) // n)
    return min(62, (rows * spread - 1).bit_length())


def slice_of(order: str, bits: int = SLICE_BITS) -> Column:
    return F.shiftright(F.col(order).cast("bigint"), bits)


def running_totals(
    df: DataFrame, group: Sequence[str], order: str, amounts: dict[str, Column], bits: int = SLICE_BITS
) -> DataFrame:
    """Adds inclusive running sums of integer ``amounts`` by ``order`` in each group.

    ``order`` has to be an integer that is unique in its group. Sums run inside slices; a
    second, much smaller window runs over the slice totals. The wide columns of ``df`` are
    shuffled once, the totals come from a scan of the narrow ones.
    """
    keys = [*group, "_slice"]
    sliced = df.withColumn("_slice", slice_of(order, bits)).withColumns(
        {f"_amount_{name}": amount.cast("bigint") for name, amount in amounts.items()}
    )
    inside = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    before = (
        sliced.groupBy(*keys)
        .agg(*[F.sum(f"_amount_{name}").alias(f"_total_{name}") for name in amounts])
        .select(*keys, *[F.sum(f"_total_{name}").over(earlier).alias(f"_before_{name}") for name in amounts])
        # First slices need no correction: most groups drop out here.
        .filter(reduce(or_, [F.col(f"_before_{name}") != 0 for name in amounts]))
    )
    summed = sliced.withColumns({name: F.sum(f"_amount_{name}").over(inside) for name in amounts})
    return summed.join(before, keys, "left").select(
        *df.columns,
        *[(F.col(name) + F.coalesce(f"_before_{name}", F.lit(0))).alias(name) for name in amounts],
    )


def position(df: DataFrame, group: Sequence[str], order: str, name: str, bits: int = SLICE_BITS) -> DataFrame:
    """Adds ``name``: the 1-based position by ``order`` in each group."""
    return running_totals(df, group, order, {name: F.lit(1)}, bits)


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and their bytes, counted where the rows are."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    size = sum((F.coalesce(F.octet_length(name), F.lit(0)) for name in texts), F.lit(8 * len(df.columns)))
    n_rows, n_bytes = df.agg(F.count("*"), F.sum(size.cast("bigint"))).first()
    return n_rows, n_bytes or 0


def fits(n_rows: int, n_bytes: int) -> bool:
    return n_rows <= BROADCAST_ROWS and n_bytes <= BROADCAST_BYTES


def is_small(df: DataFrame) -> bool:
    """Whether ``df`` may be broadcast: its rows and bytes are counted first."""
    return fits(*size_of(df))


def join_by_box(
    rows: DataFrame, per_box: DataFrame, keys: Sequence[str], max_uid: str, small: bool | None = None
) -> DataFrame:
    """Inner join of many rows ``(keys, uid)`` with a table that is unique on ``keys``.

    The small side is broadcast when it was checked to be small. Beyond that both sides are
    shuffled on keys *and* uid slice, the small side repeated once for each slice up to its
    ``max_uid``: a hot key is spread over its slices and no row is lost. ``small`` is the
    result of an ``is_small`` check that the caller has made already.
    """
    if is_small(per_box) if small is None else small:
        return rows.join(F.broadcast(per_box.drop(max_uid)), list(keys))
    repeated = per_box.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slice_of(max_uid)))
    ).drop(max_uid)
    return rows.withColumn("_slice", slice_of("uid")).join(repeated.hint("merge"), [*keys, "_slice"]).drop("_slice")


def join_salted(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], spread_by: Sequence[str], small: bool | None = None
) -> DataFrame:
    """Inner join on keys without a box, where one key (a frequent word) may be hot.

    Broadcast when ``other`` is checked to be small, else salted: rows are spread by a
    hash of ``spread_by`` and ``other`` is repeated once per salt. ``small`` is the result
    of an ``is_small`` check that the caller has made already. The hint keeps Spark from broadcasting the
    repeated rows: by its estimate they are no more than before they were repeated.
    """
    if is_small(other) if small is None else small:
        return rows.join(F.broadcast(other), list(keys))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    repeated = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated.hint("merge"), [*keys, "_salt"]).drop("_salt")
