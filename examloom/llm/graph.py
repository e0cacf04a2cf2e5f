"""Connected components of large graphs, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another node: root is the least node of its component.

    Every round relinks nodes to the least neighbour seen, so the number of
    rounds grows with the logarithm of the longest path. A round's edges are
    cut off in the shared checkpoint folder; minima are aggregated before they
    are shuffled, and nothing but two totals reaches the driver. Self-loops,
    repeated edges and nulls are dropped.
    """
    now = common.cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where((F.col(a) != F.col(b))).distinct())
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = common.cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(after)
        now = after
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
