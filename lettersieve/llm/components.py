"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettersieve.sources.shared import stored

ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest node it knows."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        near.filter("b > a").join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges(a, b)``; root is the component's smallest node.

    Nodes are integers. Edges may repeat, in either direction; loops and edges with a null
    are ignored, so that a node with nothing else has no row. Every round is a table in the
    shared folder; edges are only joined and aggregated by node, never gathered in one row.
    The number of rounds grows with the logarithm of the longest path.
    """
    state = stored(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    digest = None
    for _ in range(ROUNDS):
        state = stored(_small_star(_large_star(state)), "stars")
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == digest:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        digest = now
    raise RuntimeError("components did not settle")
