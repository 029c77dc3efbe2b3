"""Mixing of sources to target weights by entropy balancing.

Every document gets a rate, the expected number of copies. Among all rates between 0 and
``CAP`` whose expected words per source equal the source's target, the ones closest to 1 in
relative entropy are exponentially tilted, ``min(CAP, exp(lambda * size / mean size))``. The
multiplier of a source solves the convex dual; it is found by Newton steps, each one
aggregate over the table of (source, size, documents), and kept in a bracket that every step
narrows. Rates are then rounded into copies along the sizes of a source: the running sum of
fractions decides how many documents of a size get one copy more. Since copies follow rates
in order of size, a source's words miss the target by no more than its longest document. Then
``CORRECTIONS`` documents of a source at most take one copy more or less, those whose size comes
closest to what is missed.

Defined results: a null text has size 0, a null source is a source of its own and comes last.
An empty table gives no rows. Rows that repeat are rounded one by one. The result does not
depend on partitioning, so reruns agree.

Scale: texts are only read to count words. What is shuffled is (source, size) counts and
(doc_id, source, size); sizes that are very frequent in a source, at most ``HOT_SHARE`` of
them by count, are split into cells, so that a source or size with a third of all rows is
spread. The list of these sizes has a proven bound and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lettersieve.llm.common import HOT_SHARE, free_name, n_words, row_hash, same_row
from lettersieve.sources.shared import stored

CAP = 3.0
TOLERANCE = 1e-9
STEPS = 80
CORRECTIONS = 3
# Sums of doubles differ in their last digits with the order of the rows; multipliers are
# rounded, so that reruns agree.
DIGITS = 10
CELL_ROWS = 100
WEIGHTS = (1, 2, 3)


def sizes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", row: str | None = None
) -> DataFrame:
    """(doc_id, row, source, size): size is the number of words; ``row`` names equal rows, by default the id."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.col(f"`{row}`") if row else F.xxhash64(doc_id)).alias("row"),
        F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
    )


def cyclic_weights(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``weight``: the weights in turn to the sources by code point, null last.

    One row per source is sorted in one task.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    return per_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int") + 1)
    )


def targets(weighted: DataFrame, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight): words by weight, at most cap * size.

    What a source cannot take is shared out again by weight. The level at which this ends
    is found in order of cap * size / weight: the first sources in that order are full.
    """
    full = cap * F.col("source_size")
    order = W.orderBy((full / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(rest)
    filled = weighted.withColumn("_level", level).withColumn("_full", F.col("_level") * F.col("weight") > full)
    # The level that holds for all that are not full is the one of the first of them.
    return (
        filled.withColumn("_at", F.min(F.when(~F.col("_full"), F.struct(full / F.col("weight"), "_level"))).over(everything))
        .withColumn("target", F.least(full, F.coalesce(F.col("_at._level") * F.col("weight"), full)))
        .drop("_level", "_full", "_at")
    )


def _rate(tilt: Column, cap: float) -> Column:
    return F.least(F.lit(cap), F.exp(F.least(tilt, F.lit(700.0))))


def balance(histogram: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """(key, mean, tilt): the multiplier of each source, null where every rate is the cap.

    ``histogram(key, size, n)`` and ``goals(key, source_size, n_docs, target)``. The state of
    all sources is a small table, written after each step.
    """
    state = stored(
        goals.filter("source_size > 0")
        .withColumn("mean", F.col("source_size") / F.col("n_docs"))
        .select(
            "key",
            "mean",
            (F.col("target") / F.col("mean")).alias("goal"),
            (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).alias("done"),
            F.lit(0.0).alias("tilt"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
        ),
        "tilts",
    )
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt") * x, cap)
        sums = (
            histogram.join(state.filter("not done").select("key", "mean", "tilt"), "key")
            .groupBy("key")
            .agg(
                F.sum(F.col("n") * x * rate).alias("words"),
                F.sum(F.when(rate < cap, F.col("n") * x * x * rate).otherwise(0.0)).alias("slope"),
            )
        )
        short = F.col("words") < F.col("goal")
        low = F.when(short, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(short, F.col("high")).otherwise(F.col("tilt"))
        newton = F.col("tilt") + (F.col("goal") - F.col("words")) / F.col("slope")
        inside = (newton > F.coalesce(low, F.lit(float("-inf")))) & (newton < F.coalesce(high, F.lit(float("inf"))))
        wider = F.col("tilt") + F.when(short, F.lit(1.0)).otherwise(F.lit(-1.0)) * (1 + F.abs("tilt"))
        middle = F.coalesce((low + high) / 2, wider)
        # A step that leaves the bracket, or more than doubles the multiplier, is replaced.
        bounded = inside & (F.abs(newton - F.col("tilt")) <= 1 + F.abs("tilt"))
        met = F.abs(F.col("words") - F.col("goal")) <= TOLERANCE * F.col("goal")
        stuck = (high - low) <= 1e-15 * (1 + F.abs("tilt"))
        state = stored(
            state.join(sums, "key", "left").select(
                "key",
                "mean",
                "goal",
                (F.col("done") | F.coalesce(met | stuck, F.lit(False))).alias("done"),
                F.when(F.col("done") | met, F.col("tilt"))
                .when(bounded, newton)
                .otherwise(middle)
                .alias("tilt"),
                F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
                F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
            ),
            "tilts",
        )
        if state.filter("not done").isEmpty():
            break
    full = F.col("goal") * F.col("mean")
    return state.join(goals.select("key", "source_size"), "key").select(
        "key",
        "mean",
        F.when(full < cap * F.col("source_size") * (1 - 1e-12), F.round("tilt", DIGITS)).alias("tilt"),
    )


def corrected(shares: DataFrame, cap: float = CAP) -> DataFrame:
    """Copies of the cells after some single ones more or less, to meet the targets.

    ``shares(key, size, cell, n, total, target)`` has one row per cell. In each round a source
    changes one cell by one copy: the cell whose size comes closest to what the source misses.
    """
    for _ in range(CORRECTIONS):
        missed = shares.groupBy("key").agg(
            (F.max("target") - F.sum(F.col("size") * F.col("total"))).alias("missed")
        )
        step = F.when(F.col("missed") > 0, 1).otherwise(-1)
        left = F.abs(F.col("missed") - step * F.col("size"))
        fits = (F.col("total") + step).between(0, F.floor(cap * F.col("n")))
        best = (
            shares.join(missed, "key")
            .filter(fits & (left < F.abs("missed")))
            .groupBy("key")
            .agg(F.min(F.struct(left.alias("left"), "size", "cell", step.alias("step"))).alias("best"))
        )
        chosen = (F.col("best.size") == F.col("size")) & (F.col("best.cell") == F.col("cell"))
        shares = stored(
            shares.join(best, "key", "left")
            .withColumn("total", F.col("total") + F.when(chosen, F.col("best.step")).otherwise(0))
            .drop("best"),
            "copies-of-sizes",
        )
    return shares


def mix(measured: DataFrame, goals: DataFrame | None = None, cap: float = CAP) -> DataFrame:
    """(doc_id, row, source, size, source_size, target, rate, copies) of rows (doc_id, source, size).

    ``goals`` gives (source, weight); by default the weights 1, 2, 3 are dealt in turn.
    """
    if "row" not in measured.columns:
        measured = measured.withColumn("row", F.xxhash64("doc_id"))
    measured = stored(measured.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), "sizes")
    counted = measured.groupBy("key", "source", "size").agg(F.count("*").alias("n"))
    counted = stored(counted, "size-counts")
    per_source = counted.groupBy("key", "source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")
    )
    if goals is None:
        weighted = cyclic_weights(per_source)
    else:
        named = goals.select(
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"), F.col("weight").cast("double")
        )
        weighted = per_source.join(named, "key")
    aims = stored(targets(weighted, cap), "targets")
    solved = balance(counted.select("key", "size", "n"), aims, cap)
    # Sizes of source that hold too many documents for one task: at most HOT_SHARE rows.
    limit = max(CELL_ROWS, counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // HOT_SHARE)
    hot = counted.filter(F.col("n") > limit).select("key", "size", F.ceil(F.col("n") / limit).alias("parts"))
    rows = measured.join(F.broadcast(hot), ["key", "size"], "left").withColumn(
        "cell", F.coalesce(F.pmod(F.xxhash64("doc_id", "row", F.lit("cell")), F.col("parts")), F.lit(0))
    )
    per_cell = rows.groupBy("key", "size", "cell").agg(F.count("*").alias("n"))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.coalesce(_rate(F.col("tilt") * F.col("size") / F.col("mean"), cap), F.lit(cap))
    )
    fraction = F.col("rate") - F.floor("rate")
    along = W.partitionBy("key").orderBy("size", "cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    shares = (
        per_cell.join(aims.select("key", "source_size", "target"), "key")
        .join(solved, "key", "left")
        .withColumn("rate", rate)
        .withColumn("upto", F.sum(F.col("n") * fraction).over(along))
        .select(
            "key",
            "size",
            "cell",
            "source_size",
            "target",
            "rate",
            "n",
            (
                F.col("n") * F.floor("rate") + F.round("upto") - F.round(F.col("upto") - F.col("n") * fraction)
            ).cast("bigint").alias("total"),
        )
    )
    shares = corrected(stored(shares, "copies-of-sizes"), cap)
    turn = W.partitionBy("key", "size", "cell").orderBy(F.xxhash64("doc_id", "row"), "doc_id", "row")
    return (
        rows.select("doc_id", "row", "source", "key", "size", "cell", F.row_number().over(turn).alias("turn"))
        .join(shares, ["key", "size", "cell"])
        .select(
            "doc_id",
            "row",
            "source",
            "size",
            "source_size",
            "target",
            "rate",
            (F.expr("total div n") + F.when(F.col("turn") <= F.col("total") % F.col("n"), 1).otherwise(0))
            .cast("bigint")
            .alias("copies"),
        )
    )


def digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken words, copies."""
    return mix(sizes(docs)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
        "rate",
    )


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with every row as often as its copies say; rows without copies are left out.

    Whole rows meet their copies in one shuffle by a hash of their content. Rows that repeat
    are interchangeable: together they are as often there as their copies add up to.
    """
    row = free_name(docs, "row")
    marked = docs.withColumn(row, row_hash(doc_id, text, source))
    measured = sizes(marked, doc_id, text, source, row)
    chosen = stored(
        mix(measured)
        .groupBy(F.col("row").alias("_row"), F.col("doc_id").alias("_id"))
        .agg(F.sum("copies").alias("_copies"), F.count("*").alias("_n"))
        .filter("_copies > 0"),
        "copies",
    )

    time = free_name(docs, "time")

    def taken(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        joined = rows.alias("l").join(wanted.alias("r"), same_row("l", "r", row, doc_id))
        times = F.sequence(F.lit(1).cast("bigint"), F.col("r._copies"))
        return joined.select("l.*", F.explode(times).alias(time)).select(*[F.col(f"`{c}`") for c in docs.columns])

    found = taken(marked, chosen.filter("_n = 1"))
    again = chosen.filter("_n > 1")
    if not again.isEmpty():
        repeats = marked.alias("l").join(again.alias("r"), same_row("l", "r", row, doc_id), "left_semi")
        found = found.unionByName(taken(repeats.dropDuplicates([row, doc_id]), again))
    return found
