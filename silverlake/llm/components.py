"""Connected components of a graph given as pairs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlake.llm.base import stored


def components(pairs: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node it is connected with) for every node of a pair.

    Each round is aggregates and joins on the nodes and its result is stored; the number of rounds grows
    with the logarithm of the longest path. Only counts reach the driver.
    """
    edges = pairs.select(F.least(first, second).alias("v"), F.greatest(first, second).alias("u"))
    edges = stored(edges.where("u <> v").distinct(), "edges")
    before = None
    while (state := _state(edges)) != before:
        before = state
        edges = stored(_small_star(_large_star(edges)), "edges")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return members.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark % 1_000_003), F.bit_xor(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("least")), "least")
    tied = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("least", "u").alias("v"))
    return tied.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    edges = stored(edges, "edges")
    least = stored(edges.groupBy("u").agg(F.min("v").alias("least")), "least")
    tied = edges.join(least, "u")
    others = tied.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return others.unionByName(least.select("u", F.col("least").alias("v"))).distinct()
