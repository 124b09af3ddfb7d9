"""Distributed DBSCAN over a grid: cells are clustered, points only where cells are undecided."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.components import connected_components
from lakekit.operators.features import distinct_features, label_join_back, with_rank
from lakekit.operators.neighbours import (HASH_DIMS, STEP, Grid, cell_pairs, cell_table, index_points, largest_cell,
                                          neighbour_counts, too_deep)
from lakekit.session import cut_lineage

PAIR_WORK = 65_536  # two blocks are compared point by point up to this many pairs


def _core_points(points: DataFrame, cells: DataFrame, pairs: DataFrame, grid: Grid, min_points: int,
                 fullest: int) -> DataFrame:
    """points plus `core`. A cell with min_points points is all core and needs no counting,
    so only cells with fewer points send queries: a bounded number per neighbouring cell."""
    sized = points.join(cells.select("cell", "n"), "cell")
    sparse = cut_lineage(sized.where(F.col("n") < min_points).drop("n"))
    counts = neighbour_counts(points, sparse, pairs, grid, fullest)
    sparse = sparse.join(counts, "id", "left").withColumn(
        "core", F.coalesce(F.col("n_neighbours") >= min_points, F.lit(False))).drop("n_neighbours")
    dense = sized.where(F.col("n") >= min_points).drop("n").withColumn("core", F.lit(True))
    return cut_lineage(dense.unionByName(sparse))


def _linked_cells(core: DataFrame, pairs: DataFrame, grid: Grid, fullest: int) -> DataFrame:
    """(u, v) cell pairs, by cell node, holding two core points within the radius.

    Boxes settle most pairs. Of the rest, small ones are compared point by
    point and crowded ones are cut into smaller blocks and looked at again.
    """
    undecided = pairs.where("a < b").select(
        F.col("a").alias("cell_a"), F.col("b").alias("cell_b"), F.col("a").alias("block_a"), F.col("b").alias("block_b"),
        "a_n", "b_n", *[f"{side}_{c}" for side in ("a", "b") for c in grid.bound_names])
    linked, depth = None, 0
    while True:
        near, far = grid.box_box()
        judged = cut_lineage(undecided.withColumn("_near", near).withColumn("_far", far).where(
            F.col("_near") <= grid.limit))
        sure = judged.where(F.col("_far") <= grid.limit).select("cell_a", "cell_b").distinct()
        rest = judged.where(F.col("_far") > grid.limit).join(sure, ["cell_a", "cell_b"], "left_anti")
        small = rest.where(F.col("a_n") * F.col("b_n") <= PAIR_WORK)
        left = core.select(grid.block(depth).alias("block_a"), *[F.col(c).alias(f"_p{c}") for c in grid.columns])
        right = core.select(grid.block(depth).alias("block_b"), *[F.col(c).alias(f"_q{c}") for c in grid.columns])
        touching = (small.select("cell_a", "cell_b", "block_a", "block_b").join(left, "block_a").join(right, "block_b")
                    .where(grid.distance("_p", "_q") <= grid.limit).select("cell_a", "cell_b").distinct())
        here = sure.union(touching)
        if fullest * fullest <= PAIR_WORK:
            linked = here if linked is None else linked.union(here)
            break
        here = cut_lineage(here)
        linked = here if linked is None else linked.union(here)
        crowded = cut_lineage(rest.where(F.col("a_n") * F.col("b_n") > PAIR_WORK)
                              .join(here, ["cell_a", "cell_b"], "left_anti")
                              .select("cell_a", "cell_b", "block_a", "block_b"))
        if crowded.isEmpty():
            break

        def halves(side: str) -> DataFrame:
            boxes = core.groupBy(grid.block(depth).alias(f"block_{side}"), grid.block(depth + STEP).alias("child")).agg(
                *grid.bounds())
            return boxes.select(f"block_{side}", F.col("child").alias(f"child_{side}"), F.col("n").alias(f"{side}_n"),
                                *[F.col(c).alias(f"{side}_{c}") for c in grid.bound_names])

        undecided = (crowded.join(halves("a"), "block_a").join(halves("b"), "block_b").drop("block_a", "block_b")
                     .withColumnsRenamed({"child_a": "block_a", "child_b": "block_b"}))
        depth += STEP
        too_deep(depth)
    return linked.distinct()


def _border_roots(points: DataFrame, core: DataFrame, roots: DataFrame, core_pairs: DataFrame, grid: Grid) -> DataFrame:
    """(id, root): for each non-core point the smallest cluster among core points within the radius."""
    targets = core_pairs.select(F.col("a").alias("cell"), F.col("b").alias("near_cell"),
                                *[F.col(f"b_{c}").alias(c) for c in grid.bound_names])
    asked = (points.where("NOT core").select("id", *grid.columns, "cell").join(targets, "cell").drop("cell")
             .join(roots.withColumnRenamed("cell", "near_cell"), "near_cell"))
    near, far = grid.point_box()
    sure = asked.where(far <= grid.limit).select("id", "root")
    members = core.select(F.col("cell").alias("near_cell"), *[F.col(c).alias(f"_q{c}") for c in grid.columns])
    tried = asked.where((near <= grid.limit) & (far > grid.limit)).select(
        "id", "near_cell", "root", *[F.col(c).alias(f"_p{c}") for c in grid.columns])
    hits = tried.join(members, "near_cell").where(grid.distance("_p", "_q") <= grid.limit).select("id", "root")
    return sure.union(hits).groupBy("id").agg(F.min("root").alias("root"))


def cluster_points(points: DataFrame, columns: list[str], eps: float, min_points: int) -> tuple[DataFrame, int]:
    """Distinct points (id, columns, core, cluster) with a null cluster for noise, and their number.

    A point is core when at least min_points distinct points, itself included,
    lie within eps. Clusters are numbered from 0 by their smallest core point
    in coordinate order; a border point joins the smallest cluster it touches.
    """
    grid = Grid(columns, eps)
    indexed = index_points(points, grid)
    cells = cut_lineage(cell_table(indexed, grid))
    fullest, total = largest_cell(cells)
    pairs = cut_lineage(cell_pairs(cells, grid))
    marked = _core_points(indexed, cells, pairs, grid, min_points, fullest)
    core = marked.where("core")

    # cells holding core points are the nodes; each is named by its first core point
    core_cells = cut_lineage(core.groupBy("cell").agg(*grid.bounds(), F.min("id").alias("node")))
    nodes = core_cells.select("cell", "node")
    # pairs seen from every cell, with the neighbour's box narrowed to its core points
    core_side = core_cells.select(F.col("cell").alias("b"), F.col("n").alias("b_n"),
                                  *[F.col(c).alias(f"b_{c}") for c in grid.bound_names])
    to_core = cut_lineage(pairs.select("a", "b").join(core_side, "b"))
    own = core_cells.select(F.col("cell").alias("a"), F.col("n").alias("a_n"),
                            *[F.col(c).alias(f"a_{c}") for c in grid.bound_names])
    linked = _linked_cells(core, to_core.join(own, "a"), grid, fullest)
    edges = (linked.join(nodes.withColumnsRenamed({"cell": "cell_a", "node": "u"}), "cell_a")
             .join(nodes.withColumnsRenamed({"cell": "cell_b", "node": "v"}), "cell_b").select("u", "v"))
    roots = connected_components(nodes.select("node"), edges)
    roots = cut_lineage(nodes.join(roots, "node").select("cell", "root"))

    numbered = with_rank(roots.select("root").distinct(), ["root"], "cluster")
    core_roots = core.select("id", "cell").join(roots, "cell").select("id", "root")
    all_roots = core_roots.union(_border_roots(marked, core, roots, to_core, grid))
    return marked.join(all_roots, "id", "left").join(numbered, "root", "left").select(
        "id", *columns, "core", "cluster"), total


def dbscan(df: DataFrame, columns: list[str], eps: float, min_points: int, label: str = "label") -> DataFrame:
    """Every row of df with its cluster; each noise point gets a label of its own.

    Noise labels start at the number of distinct points plus one and follow
    coordinate order. More than HASH_DIMS columns are clustered by pivots instead of a grid.
    """
    if len(columns) > HASH_DIMS:
        from lakekit.operators import metric
        return metric.dbscan(df, columns, eps, min_points, label)
    clustered, total = cluster_points(distinct_features(df, columns), columns, eps, min_points)
    return label_rows(df, clustered, total, columns, label)


def label_rows(df: DataFrame, clustered: DataFrame, total: int, columns: list[str], label: str) -> DataFrame:
    """Every row of df with the label of its tuple, given the `total` distinct tuples (id, columns, cluster)."""
    clustered = cut_lineage(clustered)
    noise = with_rank(clustered.where("cluster IS NULL").select("id", *columns), ["id"], "_rank")
    labels = clustered.where("cluster IS NOT NULL").select(*columns, F.col("cluster").alias(label)).unionByName(
        noise.select(*columns, (F.col("_rank") + (total + 1)).alias(label)))
    return label_join_back(df, labels, columns, label)
