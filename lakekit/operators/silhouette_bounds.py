"""Bounds of the silhouette over Euclidean distances, far below all pairs.

Each cluster's points are put in the order of a space-filling curve and cut into runs of FAN, FAN * FAN, ... points: the
nodes of its tree. A node keeps its number of points n, their mean m and their mean squared distance v to m. For any point p the sum of
its distances to a node's points lies between n * |p - m| (the mean of norms is no less than the norm of the mean) and
n * sqrt(|p - m|^2 + v) (the mean of roots is no more than the root of the mean); a node of one point is exact.

Points ask in blocks of one cluster. A block starts at the root of every cluster. Where the gap between the bounds of a node is
more than `gap` times the least mean distance known so far between the block and that cluster, the node is opened into its children;
once all gaps of a block and a cluster add up to no more than that share, its nodes stay as they are. A cluster whose least mean
distance exceeds another's greatest can't be the nearest one and is left. Rounds go down the levels and so are as many
as the logarithm of the largest cluster. A mean distance is then known within a factor of 1 + gap, hence each point's score
within 2 * gap. The mean score's interval is mostly far narrower, so `gap` starts wide and is cut to a third
until the interval is narrow enough, at the latest with a gap of half its width.

Points are distinct tuples of finite numbers with a label that isn't null, as for `silhouette_exact`; a point alone in its
cluster scores 0, so do all points of a single cluster. An empty table gives one row with null bounds and no points. The roots of all clusters
go through one row, so this is for labels of which there are far fewer than points: noise that counts as clusters of one point each is not meant.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.operators.features import with_rank
from lakekit.session import cut_lineage, scratch_path

FAN = 8  # children a node
BLOCK_LEVEL = 3  # a block of asking points is a node of this level: FAN ** BLOCK_LEVEL points
CURVE_BITS = 60
CHUNK = 512  # nodes met by a block's points at a time

KNOWN = ("low", "high", "used")  # sums over the nodes a block has taken of a cluster: least and greatest distances, gaps
SCORED = "id bigint, low double, high double"


def _distance(x: Column, y: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(x, y, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d))


def _curve(points: DataFrame, columns: list[str]) -> Column:
    """Position on the curve that takes one bit of each column in turn; columns beyond CURVE_BITS don't count."""
    ends = points.agg(*[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(columns) for f in (F.min, F.max)]).first()
    used = columns[:CURVE_BITS]
    bits = min(16, CURVE_BITS // len(used))
    place = F.lit(0).cast("bigint")
    for i, c in enumerate(used):
        low, high = ends[f"min_{i}"], ends[f"max_{i}"]
        if low is None or high <= low:
            continue
        cell = F.floor((F.col(c) / (high - low) - low / (high - low)) * ((1 << bits) - 1)).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.shiftleft(bit, b * len(used) + i))
    return place


def _parents(nodes: DataFrame, d: int) -> DataFrame:
    """The next level's nodes; their moments come from their children's."""
    n = F.sum("n")
    mean = F.array(*[F.sum(F.col("n") * F.col("mean")[i]) / n for i in range(d)])
    grouped = nodes.groupBy("label", F.expr(f"node div {FAN}").alias("node")).agg(
        n.alias("n"), mean.alias("mean"), F.collect_list(F.struct("n", "mean", "spread")).alias("parts"))
    away = F.transform("parts", lambda c: F.struct(c["n"].alias("n"), c["spread"].alias("spread"), _distance(c["mean"], F.col("mean")).alias("far")))
    squares = F.aggregate("parts", F.lit(0.0), lambda s, c: s + c["n"] * (c["spread"] + c["far"] * c["far"]))
    return grouped.withColumn("parts", away).select("label", "node", "n", "mean", (squares / F.col("n")).alias("spread"))


class Trees:
    """One tree a cluster, written level by level; `points` holds the ranked points."""

    def __init__(self, points: DataFrame, columns: list[str], label: str):
        spark = points.sparkSession
        kept = cut_lineage(points.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
                                         F.col(label).cast("bigint").alias("label")))
        names = kept.columns[:-1]
        ranked = with_rank(kept.withColumn("_place", _curve(kept, names)), ["label", "_place", *names], "id")
        first = ranked.groupBy("label").agg(F.min("id").alias("_first"), F.count("*").alias("size"))
        leaves = ranked.join(first.select("label", "_first"), "label").select(
            "label", (F.col("id") - F.col("_first")).alias("node"), F.lit(1).cast("bigint").alias("n"),
            F.array(*names).alias("mean"), F.lit(0.0).alias("spread"))
        largest = first.agg(F.max("size")).first()[0] or 0
        self.depth = BLOCK_LEVEL
        while FAN ** self.depth < largest:
            self.depth += 1
        self.levels = [cut_lineage(leaves)]
        for _ in range(self.depth):
            self.levels.append(cut_lineage(_parents(self.levels[-1], len(names))))
        # half the mean distance to the cluster's mean is less than the mean distance from anywhere, by the triangle inequality
        self.sizes = cut_lineage(self._away(self.depth).groupBy("label").agg(F.count("*").alias("size"), (F.avg("far") / 2).alias("floor")))
        reach = self._away(BLOCK_LEVEL).groupBy("label", "top").agg(F.max("far").alias("radius")).withColumnRenamed("top", "node")
        self.blocks = cut_lineage(self.levels[BLOCK_LEVEL].join(reach, ["label", "node"]))

    def _away(self, level: int) -> DataFrame:
        """Each point's distance to the mean of its node of a level."""
        tops = self.levels[level].select("label", F.col("node").alias("top"), F.col("mean").alias("middle"))
        points = self.levels[0].withColumn("top", F.expr(f"node div {FAN ** level}"))
        return points.join(tops, ["label", "top"]).select("label", "top", _distance(F.col("mean"), F.col("middle")).alias("far"))


def _frontier(trees: Trees) -> DataFrame:
    """Every block against every cluster's root; the roots are one row, so nothing is paired by a cross join of tables."""
    roots = trees.levels[trees.depth].join(trees.sizes, "label").agg(F.collect_list(F.struct("label", "node", "n", "mean", "spread", "size", "floor")).alias("r"))
    blocks = trees.blocks.select(F.struct("label", "node").alias("block"), F.col("mean").alias("centre"), "radius")
    return blocks.join(F.broadcast(roots)).select(
        "block", "centre", "radius", F.explode("r").alias("r"), *[F.lit(0.0).alias(c) for c in KNOWN]).select(
        "block", "centre", "radius", *KNOWN, F.col("r.label").alias("cluster"), "r.size", "r.floor", "r.node", "r.n", "r.mean", "r.spread")


def _judge(open_nodes: DataFrame, gap: float) -> DataFrame:
    """Open nodes with `state`: accepted, opened, or left because their cluster can't be the nearest."""
    pair, block = Window.partitionBy("block", "cluster"), Window.partitionBy("block")
    away = _distance(F.col("centre"), F.col("mean"))
    near = F.greatest(away - F.col("radius"), F.lit(0.0))
    far = away + F.col("radius")
    least, most = F.col("n") * near, F.col("n") * F.sqrt(far * far + F.col("spread"))
    known = F.greatest("all_low", F.col("size") * F.col("floor"))
    other = F.col("cluster") != F.col("block.label")
    slack = F.sqrt(F.col("near") * F.col("near") + F.col("spread")) - F.col("near")
    met = open_nodes.withColumns({"near": near, "least": least, "most": most}).withColumn("slack", slack)
    met = met.withColumns({"all_low": F.col("low") + F.sum("least").over(pair), "all_high": F.col("high") + F.sum("most").over(pair),
                           "all_slack": F.col("used") + F.sum(F.col("n") * F.col("slack")).over(pair)})
    met = met.withColumn("best", F.min(F.when(other, F.col("all_high") / F.col("size"))).over(block))
    state = (F.when(other & (F.col("all_low") / F.col("size") > F.col("best") * (1 + 1e-9)), "left")
             .when((F.col("all_slack") <= gap * known) | (F.col("slack") <= gap * known / F.col("size")), "accepted").otherwise("opened"))
    return met.withColumn("state", state)


def _accepted(trees: Trees, gap: float) -> tuple[DataFrame, list[int]]:
    """Nodes each block takes as they are, and how many there were a round."""
    spark = trees.sizes.sparkSession
    path = scratch_path(spark, "silhouette")
    frontier, met = _frontier(trees), []
    for level in range(trees.depth, -1, -1):
        here = f"{path}/round={level}"
        judged = _judge(frontier, gap)
        judged.write.partitionBy("state").parquet(here)
        judged = spark.read.schema(judged.schema).parquet(here)
        counts = dict(judged.groupBy("state").count().collect())
        met.append(sum(counts.values()))
        if not counts.get("opened"):
            break
        # what the block knows of a cluster without its opened nodes
        kept = judged.where("state = 'accepted'").groupBy("block", "cluster").agg(
            F.sum("least").alias("_low"), F.sum("most").alias("_high"), F.sum(F.col("n") * F.col("slack")).alias("_used"))
        children = trees.levels[level - 1].withColumn("parent", F.expr(f"node div {FAN}"))
        opened = judged.where("state = 'opened'").select("block", "centre", "radius", *KNOWN, "cluster", "size", "floor", F.col("node").alias("parent"))
        opened = opened.join(kept, ["block", "cluster"], "left").withColumns({c: F.col(c) + F.coalesce(f"_{c}", F.lit(0.0)) for c in KNOWN})
        frontier = opened.join(children.withColumnRenamed("label", "cluster"), ["cluster", "parent"]).select(*frontier.columns)
    rounds = spark.read.schema(judged.schema).parquet(path)
    left = rounds.where("state = 'left'").select("block", "cluster").distinct()
    return rounds.where("state = 'accepted'").join(left, ["block", "cluster"], "left_anti"), met


def _interval(low_a, high_a, low_b, high_b):
    """Least and greatest of (b - a) / max(a, b), which falls as a / b rises."""
    def score(a, b):
        top = np.maximum(a, b)
        return np.where(top > 0, (b - a) / np.where(top > 0, top, 1.0), 0.0)

    return score(high_a, low_b), score(low_a, high_b)


def _score_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by block, its points before the nodes it took; state is one block's points and a sum per cluster."""
    current, ids, xs, sums = None, [], [], {}

    def scored() -> pd.DataFrame:
        own, size = current[0], sums[current[0]][2]
        low, high = np.full(len(ids), np.inf), np.full(len(ids), np.inf)
        for cluster, (least, most, n) in sums.items():
            if cluster != own:
                low, high = np.minimum(low, least / n), np.minimum(high, most / n)
        if size < 2 or not np.isfinite(high).all():
            worst = best = np.zeros(len(ids))
        else:
            worst, best = _interval(sums[own][0] / (size - 1), sums[own][1] / (size - 1), low, high)
        return pd.DataFrame({"id": ids, "low": worst, "high": best})

    for batch in batches:
        for (label, node, is_node), rows in batch.groupby(["label", "node", "is_node"]):
            if (label, node) != current:
                if sums:
                    yield scored()
                current, ids, xs, sums = (label, node), [], [], {}
            if not is_node:
                ids.extend(rows["id"])
                xs.extend(rows["mean"])
                continue
            points = np.asarray([np.asarray(x) for x in xs])
            for (cluster, size), part in rows.groupby(["cluster", "size"]):
                least, most, _ = sums.setdefault(cluster, (np.zeros(len(ids)), np.zeros(len(ids)), size))
                means, n, spread = np.stack(part["mean"].to_numpy()), part["n"].to_numpy(), part["spread"].to_numpy()
                for k in range(0, len(part), CHUNK):
                    square = sum((points[:, i, None] - means[None, k:k + CHUNK, i]) ** 2 for i in range(points.shape[1]))
                    least += np.sqrt(square) @ n[k:k + CHUNK]
                    most += np.sqrt(square + spread[None, k:k + CHUNK]) @ n[k:k + CHUNK]
    if sums:
        yield scored()


def silhouette_bounds(points: DataFrame, columns: list[str], label: str = "label", width: float = 0.02) -> DataFrame:
    """One row (low, high, n_points): an interval at most `width` wide that holds the mean silhouette of the labelled distinct points."""
    if not 0 < width < 1:
        raise ValueError("width must lie between 0 and 1")
    trees, gap = Trees(points, columns, label), 16 * width
    while True:
        found = bounds_of(trees, gap)
        row = found.first()
        if row["low"] is None or row["high"] - row["low"] <= width or gap <= width / 2:
            return points.sparkSession.createDataFrame([tuple(row)], found.schema)
        gap = max(gap / 3, width / 2)


def bounds_of(trees: Trees, gap: float) -> DataFrame:
    """The interval from mean distances that are known within a factor of 1 + gap."""
    taken, _ = _accepted(trees, gap)
    none = F.lit(0).cast("bigint")
    asking = trees.levels[0].select(
        "label", F.expr(f"node div {FAN ** BLOCK_LEVEL}").alias("node"), F.lit(False).alias("is_node"), F.col("node").alias("id"), "mean",
        none.alias("cluster"), none.alias("size"), none.alias("n"), F.lit(0.0).alias("spread"))
    nodes = taken.select("block.label", "block.node", F.lit(True).alias("is_node"), none.alias("id"), "mean", "cluster", "size", "n", "spread")
    rows = asking.unionByName(nodes).repartition("label", "node").sortWithinPartitions("label", "node", "is_node")
    return rows.mapInPandas(_score_blocks, SCORED).agg(
        F.avg("low").alias("low"), F.avg("high").alias("high"), F.count("*").alias("n_points"))
