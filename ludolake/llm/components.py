"""Connected components of an edge table, by alternating star contractions.

Every round is two joins on the edge table: large-star points each larger
neighbour at the smallest one, small-star does the same with the smaller
ones. Rounds grow with the logarithm of the component size, the edge table
never grows, and nothing but a checksum reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

EDGES_PER_TASK = 200_000


def _least(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.explode(F.array(
        F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Every edge points from the larger node to the smaller one here.
    joined = edges.join(_least(edges), "u")
    return (joined.select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
        .select("e.u", "e.v").filter("u <> v").distinct())


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an undirected edge table; the root
    is the smallest node reachable. Loops and repeated edges are harmless; an
    empty table gives an empty result."""
    x, y = F.col(a), F.col(b)
    edges = cut(edges.filter(x != y)
                .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    seen = _checksum(edges)
    while seen[0]:
        # As many tasks as the edges need: late rounds are small.
        edges = edges.coalesce(max(1, math.ceil(seen[0] / EDGES_PER_TASK)))
        edges = cut(_small_star(_large_star(edges)))
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
