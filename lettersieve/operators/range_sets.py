"""Union, intersection and difference of sets of uids given as closed ranges per box.

Ranges become two events each, where they begin and after they end. Running sums over the
events tell how many ranges of either side cover a place, and the result begins or ends where
the answer changes. Sums run in slices (``slices.running_totals``), so a box of any size is spread
over tasks, a range may cross any number of slices, and no range is expanded to its uids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettersieve.operators import slices

OPERATIONS: dict[str, Callable[[Column, Column], Column]] = {
    "union": lambda left, right: left | right,
    "intersection": lambda left, right: left & right,
    "difference": lambda left, right: left & ~right,
}


def _events(ranges: DataFrame, left: int, right: int) -> DataFrame:
    valid = ranges.filter(F.col("uid_lo") <= F.col("uid_hi"))
    ends = F.explode(
        F.array(
            F.struct(F.col("uid_lo").alias("at"), F.lit(1).alias("step")),
            F.struct((F.col("uid_hi") + 1).alias("at"), F.lit(-1).alias("step")),
        )
    )
    return valid.select("box", ends.alias("end")).select(
        "box", "end.at", (F.col("end.step") * left).alias("left"), (F.col("end.step") * right).alias("right")
    )


def combined(left: DataFrame, right: DataFrame, operation: str, bits: int = slices.SLICE_BITS) -> DataFrame:
    """(box, uid_lo, uid_hi): the uids of ``operation`` as ranges with gaps between them.

    ``left`` and ``right`` are (box, uid_lo, uid_hi). Ranges of a side may overlap, touch and repeat; one
    that ends before it begins is empty.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"operation must be one of {', '.join(OPERATIONS)}, not {operation!r}")
    holds = OPERATIONS[operation]
    events = (
        _events(left, 1, 0)
        .unionByName(_events(right, 0, 1))
        .groupBy("box", "at")
        .agg(F.sum("left").alias("left"), F.sum("right").alias("right"))
    )
    covered = slices.running_totals(events, ["box"], "at", {"in_left": F.col("left"), "in_right": F.col("right")}, bits)
    inside = holds(F.col("in_left") > 0, F.col("in_right") > 0)
    was_inside = holds(F.col("in_left") > F.col("left"), F.col("in_right") > F.col("right"))
    borders = covered.filter(inside != was_inside).select("box", "at", inside.cast("int").alias("begins"))
    # Beginnings and ends alternate, so an end has the number of the beginning before it.
    numbered = slices.running_totals(borders, ["box"], "at", {"number": F.col("begins")}, bits)
    return numbered.groupBy("box", "number").agg(
        F.min("at").alias("uid_lo"), (F.max("at") - 1).alias("uid_hi")
    ).drop("number")
