"""Packing into length buckets whose boundaries minimise padding.

One global histogram of lengths decides the bucket boundaries: dynamic programming over its
bins finds the ``buckets`` boundaries with the least padded total. A document goes to the
first boundary that holds it, and inside a bucket documents are dealt to batches of
``budget // boundary`` rows, so that no padded batch is over the token budget. A document that
is longer than the budget gets a batch of its own.

The histogram is exact up to ``FINE`` tokens and has ``FINE`` bins for each doubling beyond,
so it has some thousand bins whatever the table holds; every bin keeps its documents,
tokens and longest length, which makes the cost of a boundary exact. The bins, never the
documents, come to the driver.

Defined results: null and empty texts have length 0 and share the first bucket; an empty
table gives no rows; ties and repeated rows are packed one by one; reruns give equal batches.
Buckets are numbered in cells of a bounded number of rows, so a bucket with most of the
documents is spread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettersieve.llm.common import n_words, numbered
from lettersieve.sources.shared import stored

FINE = 512
BUCKETS = 16
BUDGET = 16_384
CELL_ROWS = 500
CELLS = 10_000


def bin_of(length: Column) -> Column:
    """Number of the histogram bin: lengths to FINE one by one, then FINE bins a doubling."""
    power = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double")) + F.lit(1e-12)).cast("int")
    shift = F.greatest(power - int(np.log2(FINE)), F.lit(0))
    return (shift.cast("bigint") * FINE + F.floor(length / F.pow(F.lit(2.0), shift))).cast("bigint")


@dataclass(frozen=True)
class Bin:
    number: int
    n: int
    tokens: int
    longest: int


def histogram(measured: DataFrame) -> list[Bin]:
    """Bins of (length) rows in ascending order: a bounded number of rows."""
    found = (
        measured.groupBy(bin_of(F.col("length")).alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.max("length").alias("longest"))
        .collect()
    )
    return sorted((Bin(*row) for row in found), key=lambda b: b.number)


def boundaries(bins: list[Bin], buckets: int = BUCKETS) -> list[int]:
    """Ascending bucket boundaries with the least total padding, at most ``buckets`` of them.

    cost(i, j) = longest of bin j times the documents of bins i..j; the tokens themselves are
    the same in every split. Ties go to the smaller boundaries.
    """
    if not bins:
        return []
    upto = np.concatenate([[0], np.cumsum([b.n for b in bins])]).astype(np.float64)
    longest = np.array([b.longest for b in bins], dtype=np.float64)
    size = len(bins)
    best = np.full(size + 1, np.inf)
    best[0] = 0.0
    choices = []
    for _ in range(min(buckets, size)):
        after = np.full(size + 1, np.inf)
        choice = np.zeros(size + 1, dtype=np.int64)
        for j in range(1, size + 1):
            costs = best[:j] + longest[j - 1] * (upto[j] - upto[:j])
            choice[j] = np.argmin(costs)
            after[j] = costs[choice[j]]
        best = after
        choices.append(choice)
    ends, j = [], size
    for choice in reversed(choices):
        ends.append(int(bins[j - 1].longest))
        j = int(choice[j])
        if j == 0:
            break
    return sorted(ends)


def pack(
    measured: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, order: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Adds bucket, boundary, batch (a number in its bucket) and place (in its batch) to (.., length)."""
    measured = stored(measured, "lengths")
    bins = histogram(measured)
    ends = boundaries(bins, buckets) or [0]
    bounds = F.array(*[F.lit(e).cast("bigint") for e in ends])
    bucket = F.size(F.filter(bounds, lambda e: e < F.col("length")))
    # Cells of about CELL_ROWS rows, or CELLS of them in all where that would be more.
    total = sum(b.n for b in bins)
    rows = max(CELL_ROWS, -(-total // CELLS))
    per_bucket = [0] * len(ends)
    for b in bins:
        per_bucket[sum(e < b.longest for e in ends)] += b.n
    cells = F.array(*[F.lit(-(-n // rows) or 1).cast("bigint") for n in per_bucket])
    placed = measured.withColumn("bucket", bucket).withColumns(
        {
            "boundary": F.element_at(bounds, F.col("bucket") + 1),
            "_cell": F.pmod(F.xxhash64(*order), F.element_at(cells, F.col("bucket") + 1)),
        }
    )
    held = F.greatest(F.floor(F.lit(budget) / F.greatest("boundary", F.lit(1))), F.lit(1))
    at = F.col("_at") - 1
    return (
        numbered(placed, ["bucket"], [F.xxhash64(*order, F.lit("order")), *order], "_at", "_cell")
        .withColumn("batch", F.floor(at / held).cast("bigint"))
        .withColumn("place", (at % held).cast("bigint"))
        .drop("_at", "_cell")
    )


def lengths(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), n_words(F.col(text)).alias("length"))


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, length, bucket, boundary, batch, place) of every document."""
    return pack(lengths(docs)).select("doc_id", "length", "bucket", "boundary", "batch", "place")
