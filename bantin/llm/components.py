"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bantin.llm.common import discard, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for all nodes of the edges (a, b); nodes are longs.

    Large-star and small-star steps in turn: every node links its larger neighbours, then its smaller
    ones, to the smallest it knows. The edges never grow in number, and a few rounds settle them.
    Every step is stored in the shared folder; a hot node's edges are a skewed join, which adaptive
    execution splits. Nothing is collected but a count and a checksum.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = _state(edges)
    n = before[0]  # few edges need few tasks
    while True:
        ways = stored(_both_ways(edges), 2 * n)
        first = stored(ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), 2 * n)
        large = ways.join(first, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, n)
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), n)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges, old = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), n), edges
        discard(old, ways, first, large, least)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
