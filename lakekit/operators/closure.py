"""Recursion over a step relation by squaring it: a number of rounds that grows with the logarithm of the longest chain.

Round k knows of every node where 2^k steps lead and what they add up to; joining that relation with itself doubles the steps. A recursive
query takes one join per step instead. Every round is written to the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.session import cut_lineage


def follow_chains(nodes: DataFrame, node: str, step: str, value: str) -> DataFrame:
    """Per node: node, last (the node its chain ends with), steps (to there), total (of `value` along the chain, both ends included).

    Each row is one node, named once, and the node its step leads to; a null step, or one to a node that isn't there, ends the chain. Chains
    that run into a circle have no end: last and total are null, steps is null too. Null values add nothing; rows without a name are left
    out. Chains that share an end make its join skewed on one side only, which AQE splits.
    """
    named = nodes.where(F.col(node).isNotNull()).select(
        F.col(node).alias("node"), F.col(step).alias("jump"), F.coalesce(value, F.lit(0)).alias("total"))
    known = named.select(F.col("node").alias("jump"), F.lit(True).alias("_there"))
    there = F.col("_there").isNotNull()
    state = cut_lineage(named.join(known, "jump", "left").select(
        "node", F.when(there, F.col("jump")).alias("jump"), there.cast("bigint").alias("steps"), "total",
        F.when(~there, F.col("node")).alias("last")))
    open_, rounds = state.where("jump is not null").count(), 0
    limit = max(state.count(), 1).bit_length() + 1  # a chain has no more steps than there are nodes
    while open_ and rounds < limit:
        ahead = state.select(F.col("node").alias("jump"), F.col("jump").alias("_jump"), F.col("steps").alias("_steps"),
                             F.col("total").alias("_total"), F.col("last").alias("_last"))
        state = cut_lineage(state.join(ahead, "jump", "left").select(
            "node", F.col("_jump").alias("jump"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            (F.col("total") + F.coalesce("_total", F.lit(0))).alias("total"), F.coalesce("last", "_last").alias("last")))
        open_, rounds = state.where("jump is not null").count(), rounds + 1
    ended = F.col("last").isNotNull()
    return state.select("node", "last", F.when(ended, F.col("steps")).alias("steps"), F.when(ended, F.col("total")).alias("total"))


def reachable(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """All pairs (u, v, steps): v can be reached from u along edges (u, v), in `steps` at least. Rounds double the length of the paths covered."""
    known = cut_lineage(edges.where("u is not null and v is not null").select("u", "v", F.lit(1).cast("bigint").alias("steps")).distinct())
    size = known.count()
    for _ in range(rounds):
        ahead = known.select(F.col("u").alias("v"), F.col("v").alias("w"), F.col("steps").alias("more"))
        longer = known.join(ahead, "v").select("u", F.col("w").alias("v"), (F.col("steps") + F.col("more")).alias("steps"))
        known = cut_lineage(known.union(longer).groupBy("u", "v").agg(F.min("steps").alias("steps")))
        before, size = size, known.count()
        if size == before:
            break
    return known
