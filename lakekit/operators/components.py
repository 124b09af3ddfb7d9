"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.session import cut_lineage



def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour (itself included)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Size and order-free checksum of an edge set."""
    check = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), check).first())


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) for every node; the root is the smallest node it connects to.

    nodes(node BIGINT), edges(u BIGINT, v BIGINT). Minima are partially
    aggregated before the shuffle. A hub's edges are one side of a join with one row on the
    other, which AQE splits, so they are never gathered. Every round is written out, and the loop ends when the edges stop
    changing.
    """
    current = cut_lineage(edges.where("u <> v").distinct())
    state = _state(current)
    while state[0]:
        current = cut_lineage(_small_star(_large_star(current)))
        after = _state(current)
        if after == state:
            break
        state = after
    return nodes.join(current.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))
