"""Neighbour counts within a radius over a grid that refines where it is crowded.

Points are distinct tuples with an id. Cells have side eps/sqrt(d), so points of
one cell are always neighbours. A point and a block of points are compared by
the block's bounding box first: entirely inside the radius adds the block's
size, entirely outside adds nothing, and only a block cut by the radius is
opened, into smaller blocks while it is crowded and into points once it is
small. Crowded cells are therefore never paired point by point as a whole.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.session import cut_lineage

LEAF = 256        # blocks up to this many points are compared point by point
STEP = 2          # a crowded block is cut into (2**STEP)**d blocks
MAX_DEPTH = 40    # a block this deep holds points closer than the radius' last bits; beyond it is an error
HASH_DIMS = 3     # dimensions used to find neighbouring cells: those that tell the most cells apart


class Grid:
    """Cell arithmetic for `d` coordinate columns and a radius."""

    def __init__(self, columns: list[str], eps: float):
        if eps <= 0:
            raise ValueError("epsilon must be positive")
        self.columns, self.eps, self.d = columns, float(eps), len(columns)
        # a hair under eps/sqrt(d), so a cell's diagonal stays within eps in floating point
        self.side = self.eps / math.sqrt(self.d) * (1 - 1e-9)
        self.reach = 2 + int(math.sqrt(self.d))
        self.limit = F.lit(self.eps * self.eps)

    def index(self, name: str, depth: int = 0) -> Column:
        """Grid index of a coordinate; scaling by a power of two is exact, so depths nest."""
        return F.floor(F.col(name) / F.lit(self.side) * F.lit(float(2 ** depth)))

    def block(self, depth: int = 0) -> Column:
        return F.concat_ws(":", *[self.index(c, depth).cast("string") for c in self.columns])

    def bounds(self) -> list[Column]:
        out = [F.count("*").alias("n")]
        for i, c in enumerate(self.columns):
            out += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        return out

    @property
    def bound_names(self) -> list[str]:
        return [f"{side}{i}" for i in range(self.d) for side in ("lo", "hi")]

    def distance(self, left: str, right: str) -> Column:
        """Squared distance of two points whose coordinates carry a name prefix."""
        return reduce(add, [(F.col(f"{left}{c}") - F.col(f"{right}{c}")) * (F.col(f"{left}{c}") - F.col(f"{right}{c}"))
                            for c in self.columns])

    def point_box(self) -> tuple[Column, Column]:
        """Least and greatest squared distance of point columns to the box lo/hi."""
        least, most = [], []
        for i, c in enumerate(self.columns):
            under, over = F.col(f"lo{i}") - F.col(c), F.col(c) - F.col(f"hi{i}")
            near = F.greatest(under, over, F.lit(0.0))
            far = F.greatest(F.abs(under), F.abs(over))
            least.append(near * near)
            most.append(far * far)
        return reduce(add, least), reduce(add, most)

    def box_box(self) -> tuple[Column, Column]:
        """Least and greatest squared distance of boxes a_lo/a_hi and b_lo/b_hi."""
        least, most = [], []
        for i in range(self.d):
            under, over = F.col(f"b_lo{i}") - F.col(f"a_hi{i}"), F.col(f"a_lo{i}") - F.col(f"b_hi{i}")
            near = F.greatest(under, over, F.lit(0.0))
            far = F.greatest(F.abs(F.col(f"b_hi{i}") - F.col(f"a_lo{i}")), F.abs(F.col(f"a_hi{i}") - F.col(f"b_lo{i}")))
            least.append(near * near)
            most.append(far * far)
        return reduce(add, least), reduce(add, most)


def index_points(points: DataFrame, grid: Grid) -> DataFrame:
    """Points with `cell` and an `id` that grows in coordinate order, checkpointed.

    Range partitions sorted within make the row id follow the order; it has gaps.
    """
    ordered = points.select(*grid.columns).repartitionByRange(*grid.columns).sortWithinPartitions(*grid.columns)
    return cut_lineage(ordered.withColumn("id", F.monotonically_increasing_id()).withColumn("cell", grid.block()))


def cell_table(points: DataFrame, grid: Grid) -> DataFrame:
    """(cell, n, bounds): one row per occupied cell."""
    spread = reduce(add, [(F.col(f"hi{i}") - F.col(f"lo{i}")) * (F.col(f"hi{i}") - F.col(f"lo{i}"))
                          for i in range(grid.d)])
    # holds unless coordinates are too large for double precision at this radius
    checked = F.when(spread <= grid.limit, F.col("n")).otherwise(
        F.raise_error(F.lit("epsilon is too small for the size of the coordinates")).cast("bigint"))
    return points.groupBy("cell").agg(*grid.bounds()).withColumn("n", checked)


def _coarse(grid: Grid, i: int) -> Column:
    return F.floor(F.col(f"lo{i}") / F.lit(grid.side * grid.reach)).cast("long")


def hash_dims(cells: DataFrame, grid: Grid) -> list[int]:
    """The HASH_DIMS dimensions with the most coarse buckets, so constant ones are left out."""
    if grid.d <= HASH_DIMS:
        return list(range(grid.d))
    spread = cells.agg(*[F.approx_count_distinct(_coarse(grid, i)).alias(f"d{i}") for i in range(grid.d)]).first()
    return sorted(sorted(range(grid.d), key=lambda i: (-spread[f"d{i}"], i))[:HASH_DIMS])


def too_deep(depth: int) -> None:
    """Blocks halve STEP times a round; distinct doubles part long before MAX_DEPTH rounds of that."""
    if depth > MAX_DEPTH:
        raise RuntimeError("points crowd closer than the radius can resolve in double precision")


def cell_pairs(cells: DataFrame, grid: Grid) -> DataFrame:
    """(a, b, b_n, bounds of both) for cells whose boxes come within the radius, own cell included.

    Cells meet through coarse buckets over the dimensions that part them best: an
    equi-join on the bucket, never a product of all cells.
    """
    dims = hash_dims(cells, grid)
    index = [_coarse(grid, i) for i in dims]

    def named(prefix: str, buckets: list[Column]) -> DataFrame:
        return cells.select(F.col("cell").alias(prefix), F.col("n").alias(f"{prefix}_n"),
                            *[F.col(c).alias(f"{prefix}_{c}") for c in grid.bound_names],
                            *[b.alias(f"_g{i}") for i, b in zip(dims, buckets)])

    left = named("a", index)
    for i in dims:
        left = left.withColumn(f"_g{i}", F.explode(F.array(*[F.col(f"_g{i}") + s for s in (-1, 0, 1)])))
    right = named("b", index)
    near, _ = grid.box_box()
    return left.join(right, [f"_g{i}" for i in dims]).where(near <= grid.limit).drop(*[f"_g{i}" for i in dims])


def largest_cell(cells: DataFrame) -> tuple[int, int]:
    """Points of the fullest cell, and points of all cells."""
    row = cells.agg(F.max("n"), F.sum("n")).first()
    return row[0] or 0, row[1] or 0


def neighbour_counts(points: DataFrame, queries: DataFrame, pairs: DataFrame, grid: Grid, fullest: int) -> DataFrame:
    """(id, n_neighbours) for each query point, itself included.

    points(id, coordinates, cell) and queries (some of the points) are
    checkpointed tables, pairs comes from `cell_pairs`, and `fullest` is the
    size of the fullest cell.
    """
    bounds = [F.col(f"b_{c}").alias(c) for c in grid.bound_names]
    targets = pairs.select(F.col("a").alias("cell"), F.col("b").alias("block"), F.col("b_n").alias("n"), *bounds)
    ask = queries.select("id", *grid.columns, "cell").join(targets, "cell").drop("cell")
    crowded = fullest > LEAF
    found, depth = [], 0
    while True:
        near, far = grid.point_box()
        open_ = (near <= grid.limit) & (far > grid.limit)
        found.append(ask.where(far <= grid.limit).select("id", "n"))
        leaves = ask.where(open_ & (F.col("n") <= LEAF))
        members = points.select(grid.block(depth).alias("block"), *[F.col(c).alias(f"_q{c}") for c in grid.columns])
        hits = (leaves.select("id", "block", *[F.col(c).alias(f"_p{c}") for c in grid.columns])
                .join(members, "block").where(grid.distance("_p", "_q") <= grid.limit))
        found.append(hits.groupBy("id").agg(F.count("*").alias("n")))
        if not crowded:
            # no block is open, as none holds more than LEAF points
            break
        opened = cut_lineage(ask.where(open_ & (F.col("n") > LEAF)).select("id", *grid.columns, "block"))
        if opened.isEmpty():
            break
        children = points.groupBy(grid.block(depth).alias("block"), grid.block(depth + STEP).alias("child")).agg(
            *grid.bounds())
        ask = opened.join(children, "block").drop("block").withColumnRenamed("child", "block")
        depth += STEP
        too_deep(depth)
    total = reduce(DataFrame.unionByName, found)
    return total.groupBy("id").agg(F.sum("n").alias("n_neighbours"))


def eps_neighbours(points: DataFrame, columns: list[str], eps: float) -> DataFrame:
    """Coordinates and neighbour count (itself included) of every distinct point. Beyond HASH_DIMS columns a grid's cells
    meet far too often; pivots part the points there."""
    grid = Grid(columns, eps)
    if grid.d > HASH_DIMS:
        from lakekit.operators import metric
        return metric.eps_neighbours(points, columns, eps)
    indexed = index_points(points, grid)
    cells = cut_lineage(cell_table(indexed, grid))
    # written out: renaming many filtered columns would make the optimizer derive every combination of names
    pairs = cut_lineage(cell_pairs(cells, grid))
    counts = neighbour_counts(indexed, indexed, pairs, grid, largest_cell(cells)[0])
    return indexed.join(counts, "id").select(*columns, "n_neighbours")
