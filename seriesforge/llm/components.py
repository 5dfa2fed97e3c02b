"""Connected components of a large edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is moved to the node's smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are moved to its smallest neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Each round is two aggregations and two joins by node. Minima are combined in the map tasks, the
    joins are plain equi-joins that adaptive execution splits at hubs, and each round is written
    to the shared folder, so lineage stays short. Self-loops are dropped. Star contraction ends
    after about the square of the logarithm of a component's diameter; ``rounds`` only guards
    against a fault and raises.
    """
    state = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = materialize(state, "edges")
    seen = None
    for _ in range(rounds):
        state = materialize(_small_star(_large_star(state)), "stars")
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            nodes = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return nodes.unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = mark
    raise RuntimeError(f"components did not settle in {rounds} rounds")
