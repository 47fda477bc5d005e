"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, itself included; ``edges`` holds (u, v)."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) of all nodes in ``edges`` (a, b).

    Neighbours are hung on the smallest one, in turn of the larger and of the smaller neighbours,
    until every node hangs on its component's smallest. All is minima and joins, and each state is a
    table; the number of turns grows with the logarithm of the longest path.
    """
    pairs = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = saved(larger.where("u <> v").distinct(), "edges")
        smaller = hung.join(_least(hung), "u")
        linked = smaller.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smaller.select("u", F.col("m").alias("v")))
        after = saved(linked.where("u <> v").distinct(), "edges")
        # Done when every node hangs on one node that hangs on none.
        one = after.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v"))
        roots = one.select(F.col("u").alias("v")).join(after.select("v").distinct(), "v").limit(1).count()
        pairs = after
        if not roots and not one.where("n > 1").limit(1).count():
            break
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
