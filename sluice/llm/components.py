"""Connected components of a graph of long ids, by alternating star contraction.

Every round joins each node's edges with the smallest neighbour (large star: larger
neighbours move to it; small star: smaller ones do) until the edges are one star per
component. Rounds grow with the logarithm of the longest path. Each round is
checkpointed; nothing but a count and a hash of the edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _signature(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").bitwiseAND((1 << 40) - 1)
    return tuple(edges.agg(F.count("u"), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.join(least, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m"))
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node that has
    an edge, roots left out. Edges may come in any direction, repeated or as loops."""
    larger, smaller = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    current = checkpointed(edges.select(larger, smaller).filter("u != v").distinct())
    before = None
    while (now := _signature(current)) != before:
        before = now
        current = checkpointed(_small_star(_large_star(current)))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
