"""Neighbours within a radius over many columns, by pivots, rings and the triangle inequality.

A grid parts points by a few columns only; with dozens of columns its cells meet far too often. Here a point belongs to the nearest of
a few pivot points and to a ring around it, one radius wide. Two points within the radius differ by at most the radius in their
distance to any pivot, so a point of pivot p has neighbours at pivot q only if it is less than two radii farther from q
than from p. Points are kept in blocks of one ring, and blocks in order make up tiles. A tile goes once to every tile that its least and
greatest distances to the pivots let it meet, one cell of the triangle of tiles a task: the number of tiles is fixed as long as a tile
holds at most TILE points, so what is moved grows with the points and not with their pairs. Within a cell blocks are told apart by their
distances to all pivots; what remains is compared by matrix products, and pairs that rounding could turn by squares summed in column order.
A cell gives a count or one link a point, never its pairs.

Pivots are drawn farthest first from SAMPLE points by hash. They settle how much is compared, never the result. Points that no pivot parts are
all compared, which stays quadratic in time.
A crowded ring is dealt to tasks by its points' distances to the next pivot, so it may hold any share of them. Every
intermediate is written to the shared folder.

Points are distinct tuples of finite numbers, as `distinct_features` gives them. An empty table gives no rows. The definitions of
neighbour, core, border and noise are those of `neighbours` and `dbscan`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.components import connected_components
from lakekit.operators.dbscan import label_rows
from lakekit.operators.features import distinct_features, with_rank
from lakekit.session import cut_lineage

PIVOTS = 16
SAMPLE = 2000
BLOCK = 128
TILES = 24         # tiles of a table, so a tile is sent about as often
TILE = 100_000     # points a tile should hold at most; beyond it there are more tiles
CHUNK = 4096       # points a block is compared with at a time
EDGES = 1 << 20    # links a cell keeps before they are cut down to one a point

RINGED = "home int, ring bigint, second int, far double, id bigint, v array<double>"
BLOCKS = "block bigint, home int, ring bigint, n int, ids array<bigint>, vectors binary, low array<double>, high array<double>"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _rows(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(values.ravel()))


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(points), len(pivots)))
    for k, pivot in enumerate(pivots):
        out[:, k] = np.sqrt(((points - pivot) ** 2).sum(axis=1))
    return out


def choose_pivots(points: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Up to `count` points far from each other, out of SAMPLE points."""
    sample = points.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toArrow()["v"].combine_chunks()
    if not len(sample):
        return np.zeros((0, 1))
    rows = _matrix(sample, len(sample[0]))
    chosen = [0]
    gap = to_pivots(rows, rows[:1])[:, 0]
    while len(chosen) < min(count, len(rows)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, to_pivots(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def _ringed(pivots: np.ndarray, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = to_pivots(_matrix(batch.column(1), pivots.shape[1]), pivots)
            order = np.argsort(away, axis=1, kind="stable")
            home, second = order[:, 0], order[:, min(1, len(pivots) - 1)]
            every = np.arange(len(away))
            yield pa.RecordBatch.from_arrays([
                pa.array(home, pa.int32()), pa.array(np.floor(away[every, home] / eps).astype(np.int64)), pa.array(second, pa.int32()),
                pa.array(away[every, second]), batch.column(0), batch.column(1)], names=["home", "ring", "second", "far", "id", "v"])

    return run


def _blocks(pivots: np.ndarray):
    """Rows sorted by ring -> blocks of at most BLOCK points of one ring."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            home, ring, ids = (batch.column(k).to_numpy() for k in (0, 1, 4))
            points = _matrix(batch.column(5), pivots.shape[1])
            away = to_pivots(points, pivots)
            runs = np.flatnonzero(np.concatenate([[True], (home[1:] != home[:-1]) | (ring[1:] != ring[:-1])]))
            begins = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(runs, np.append(runs[1:], len(home)))])
            ends = np.append(begins[1:], len(home))
            yield pa.RecordBatch.from_arrays([
                pa.array(number + np.arange(len(begins))), pa.array(home[begins], pa.int32()), pa.array(ring[begins]),
                pa.array(ends - begins, pa.int32()), pa.ListArray.from_arrays(pa.array(np.append(begins, len(home)), pa.int32()), pa.array(ids)),
                pa.array([points[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                _rows(np.minimum.reduceat(away, begins)), _rows(np.maximum.reduceat(away, begins))],
                names=["block", "home", "ring", "n", "ids", "vectors", "low", "high"])
            number += len(begins)

    return run


def _slack(eps: float, *sizes: np.ndarray) -> np.ndarray:
    """The radius and what rounding may add to a difference of distances."""
    return eps + 1e-9 * (eps + sum(np.abs(s) for s in sizes))


def _meets(low, high, home, k: int, others: slice, eps: float) -> np.ndarray:
    """Which of the other blocks can hold neighbours of block k's points."""
    reach = _slack(eps, high[k], high[others])
    near = ((low[k] - high[others] <= reach) & (low[others] - high[k] <= reach)).all(axis=1)
    at, own = home[others], home[k]
    every = np.arange(len(at))
    # the points' nearest pivots: within two radii of being the other's
    far = low[k][at] - high[k, own] <= 2 * reach[every, at]
    back = low[others][:, own] - high[others][every, at] <= 2 * reach[:, own]
    return near & far & back


class Cell:
    """The blocks of two tiles, or of one, side by side: their points and what is known of them."""

    def __init__(self, batch: pa.Table, width: int, pivots: int):
        self.home, self.n, self.second = (batch[c].to_numpy() for c in ("home", "n", "second"))
        self.ids = batch["ids"].combine_chunks().flatten().to_numpy()
        self.points = np.frombuffer(b"".join(batch["vectors"].to_pylist())).reshape(-1, width)
        self.low, self.high = (_matrix(batch[c].combine_chunks(), pivots) for c in ("low", "high"))
        flags = batch["flags"].combine_chunks()
        self.core = None if flags.null_count else flags.flatten().to_numpy(zero_copy_only=False)
        self.starts = np.concatenate([[0], np.cumsum(self.n)])
        with np.errstate(all="ignore"):
            self.squares = (self.points * self.points).sum(axis=1)
            self.left = np.column_stack([-2 * self.points, np.ones(len(self.points))])
            self.right = np.column_stack([self.points, self.squares])

    def pairs(self, eps: float) -> Iterator[tuple[int, np.ndarray]]:
        """(block, blocks it is to be compared with): each pair once, a block with itself if the cell is one tile's."""
        one = not self.second.any()
        first = len(self.n) if one else int(self.second.argmax())  # blocks of the first tile come first
        for k in range(first):
            others = slice(k if one else first, len(self.n))
            yield k, np.flatnonzero(_meets(self.low, self.high, self.home, k, others, eps)) + others.start

    def places(self, blocks: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(self.starts[b], self.starts[b + 1]) for b in blocks]) if len(blocks) else np.zeros(0, np.int64)

    def hits(self, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
        """(places, places, which are neighbours, whether both are the same block) of all pairs that are compared."""
        for k, blocks in self.pairs(eps):
            rows = np.arange(self.starts[k], self.starts[k + 1])
            if len(blocks) and blocks[0] == k:
                yield rows, rows, self.near(rows, rows, eps), True
                blocks = blocks[1:]
            columns = self.places(blocks)
            for at in range(0, len(columns), CHUNK):
                some = columns[at:at + CHUNK]
                yield rows, some, self.near(rows, some, eps), False

    def near(self, rows: np.ndarray, columns: np.ndarray, eps: float) -> np.ndarray:
        """As `near_matrix`: distances by a matrix product, those within its rounding of the radius once more."""
        whole = len(columns) and columns[-1] - columns[0] == len(columns) - 1
        right = self.right[columns[0]:columns[-1] + 1] if whole else self.right[columns]
        with np.errstate(all="ignore"):
            product = self.left[rows[0]:rows[-1] + 1] @ right.T  # the square of the distance less that of the row's point
            own = self.squares[rows]
            slack = 16 * (self.points.shape[1] + 8) * np.finfo(float).eps * (own.max() + self.squares[columns].max() + eps * eps)
            limit = eps * eps - own
            sure = product <= (limit - slack)[:, None]
            apart = product > (limit + slack)[:, None]
        open_ = sure.size - np.count_nonzero(sure) - np.count_nonzero(apart)
        if not open_:
            return sure
        if open_ > sure.size // 8:
            return near_matrix(self.points[rows], self.points[columns], eps)
        i, j = (~(sure | apart)).nonzero()
        total = np.zeros(len(i))
        for x, y in zip(self.points[rows[i]].T, self.points[columns[j]].T):
            gap = x - y
            total += gap * gap
        sure[i, j] = total <= eps * eps
        return sure


def _cells(work: Callable, width: int, pivots: int, eps: float):
    """Rows sorted by cell, tile and block -> `work(cell, eps)` of every cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            i, j = (batch.column(k).to_numpy() for k in (0, 1))
            starts = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
            for a, b in zip(starts, np.append(starts[1:], len(i))):
                if key != (i[a], j[a]) and held:
                    yield from work(Cell(pa.Table.from_batches(held), width, pivots), eps)
                    held = []
                key = (i[a], j[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from work(Cell(pa.Table.from_batches(held), width, pivots), eps)

    return run


class Blocks:
    """Points (id, v) in blocks, blocks in tiles, and the pairs of tiles that can hold neighbours."""

    def __init__(self, points: DataFrame, eps: float, pivots: int = PIVOTS):
        if eps <= 0:
            raise ValueError("epsilon must be positive")
        chosen = choose_pivots(points, pivots)
        self.eps, self.width, self.pivots = float(eps), chosen.shape[1], len(chosen)
        ringed = points.select("id", "v").mapInArrow(_ringed(chosen, self.eps), RINGED)
        keys = ["home", "ring", "second", "far", "id"]
        self.blocks = cut_lineage(ringed.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_blocks(chosen), BLOCKS))
        total = self.blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        count = max(TILES, -(-total // TILE))
        cuts = self.blocks.agg(F.percentile_approx("block", [k / count for k in range(1, count)], 100 * count)).first()[0] or []
        self.tile = F.size(F.filter(F.array(*(F.lit(c).cast("bigint") for c in sorted(set(cuts)))), lambda c: c < F.col("block")))
        self.cells = self._meeting()

    def _meeting(self) -> list[tuple[int, int]]:
        """Pairs of tiles whose distances to every pivot come within the radius; a row per tile comes to the driver."""
        if not self.pivots:
            return []
        ends = [f(F.col(c)[k]) for c, f in (("low", F.min), ("high", F.max)) for k in range(self.pivots)]
        rows = self.blocks.groupBy(self.tile.alias("tile")).agg(F.array(*ends[:self.pivots]), F.array(*ends[self.pivots:])).collect()
        out = []
        for a in sorted(rows):
            for b in rows:
                if b[0] >= a[0]:
                    low, high = (np.array([x[k] for x in (a, b)]) for k in (1, 2))
                    reach = _slack(self.eps, high[0], high[1])
                    if ((low[0] - high[1] <= reach) & (low[1] - high[0] <= reach)).all():
                        out.append((a[0], b[0]))
        return out

    def compare(self, work: Callable, schema: str, flags: DataFrame | None = None) -> DataFrame:
        """`work(cell, eps)` of all pairs of tiles that can hold neighbours."""
        blocks = self.blocks.select("*", self.tile.alias("tile"), F.lit(None).cast("array<boolean>").alias("flags"))
        if flags is not None:
            blocks = blocks.drop("flags").join(flags, "block")
        sent = [(tile, i, j, side) for i, j in self.cells for side, tile in enumerate((i, j)[:1 if i == j else 2])]
        where = F.broadcast(self.blocks.sparkSession.createDataFrame(sent, "tile int, i int, j int, second int"))
        dealt = blocks.join(where, "tile").select("i", "j", "second", "block", "home", "n", "ids", "vectors", "low", "high", "flags")
        dealt = dealt.repartition(max(len(self.cells), 1), "i", "j").sortWithinPartitions("i", "j", "second", "block")
        return dealt.mapInArrow(_cells(work, self.width, self.pivots, self.eps), schema)

    def candidates(self) -> int:
        """Number of pairs of points that are compared."""
        return self.compare(_compared, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def near_matrix(left: np.ndarray, right: np.ndarray, eps: float) -> np.ndarray:
    """Which rows of two matrices are within the radius; squares are summed in column order."""
    total = np.zeros((len(left), len(right)))
    for x, y in zip(left.T, right.T):
        gap = x[:, None] - y[None, :]
        total += gap * gap
    return total <= eps * eps


def _compared(cell: Cell, eps: float) -> Iterator[pa.RecordBatch]:
    n = sum(int(cell.n[k]) * int(cell.n[blocks].sum()) for k, blocks in cell.pairs(eps))
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])


def _count(cell: Cell, eps: float) -> Iterator[pa.RecordBatch]:
    n = np.zeros(len(cell.ids), np.int64)
    for rows, columns, hits, same in cell.hits(eps):
        n[rows] += np.count_nonzero(hits, axis=1)
        if not same:
            n[columns] += np.count_nonzero(hits, axis=0)
    some = n > 0
    yield pa.RecordBatch.from_arrays([pa.array(cell.ids[some]), pa.array(n[some])], names=["id", "n"])


def _roots(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least place each place is tied to, given such roots so far and more links."""
    while True:
        a, b = root[u], root[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        if not open_.any():
            return root
        u, v = u[open_], v[open_]
        np.minimum.at(root, high[open_], low[open_])
        while (root[root] != root).any():
            root = root[root]


def _link(cell: Cell, eps: float) -> Iterator[pa.RecordBatch]:
    """(u, v): core points to the first core point of the cell they are tied to within it; other points to their core neighbours."""
    root, core = np.arange(len(cell.ids)), cell.core
    held, size = [], 0
    for rows, columns, hits, same in cell.hits(eps):
        if not hits.any():
            continue
        if np.count_nonzero(hits) > hits.size // 8:  # of a crowded chunk: each point to the first core point it meets, and those to each other
            inner = hits & core[rows][:, None] & core[columns][None, :]
            some, other = inner.any(axis=1), inner.any(axis=0)
            one = _chunk_roots(inner)
            u = np.concatenate([rows[some], columns[other]])
            v = np.concatenate([rows, columns])[np.concatenate([one[:len(rows)][some], one[len(rows):][other]])]
            i, j = (hits & (core[rows][:, None] ^ core[columns][None, :])).nonzero()
        else:
            i, j = hits.nonzero()
            both = core[rows[i]] & core[columns[j]]
            u, v = rows[i[both]], columns[j[both]]
            edge = core[rows[i]] ^ core[columns[j]]
            i, j = i[edge], j[edge]
        held.append((u, v))
        size += len(u)
        if size > EDGES:
            root = _roots(root, *(np.concatenate(x) for x in zip(*held)))
            held, size = [], 0
        if same:  # each pair comes both ways
            use = ~core[rows[i]]
            i, j = i[use], j[use]
        if len(i):
            x, y = rows[i], columns[j]
            yield _links(cell, np.where(core[x], y, x), np.where(core[x], x, y), True)
    if held:
        root = _roots(root, *(np.concatenate(x) for x in zip(*held)))
    tied = np.flatnonzero(root != np.arange(len(root)))
    if len(tied):
        yield _links(cell, tied, root[tied], False)


def _chunk_roots(hits: np.ndarray) -> np.ndarray:
    """Least place tied to each row and then each column of a matrix of links; rows come before columns."""
    m, n = hits.shape
    labels = np.concatenate([np.arange(m), m + np.arange(n)])
    while True:
        one = np.minimum(labels[:m], np.where(hits, labels[None, m:], m + n).min(axis=1, initial=m + n))
        two = np.minimum(labels[m:], np.where(hits, one[:, None], m + n).min(axis=0, initial=m + n))
        new = np.concatenate([one, two])
        if (new == labels).all():
            return labels
        labels = new


def _links(cell: Cell, u: np.ndarray, v: np.ndarray, border: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cell.ids[u]), pa.array(cell.ids[v]), pa.array(np.full(len(u), border))], names=["u", "v", "border"])


def _indexed(points: DataFrame, columns: list[str]) -> DataFrame:
    """Points with an `id` in coordinate order, which has gaps, and their coordinates as one array."""
    ordered = points.select(*(F.col(c).cast("double").alias(c) for c in columns)).repartitionByRange(*columns).sortWithinPartitions(*columns)
    return cut_lineage(ordered.withColumn("id", F.monotonically_increasing_id()).withColumn("v", F.array(*columns)))


def _counts(blocks: Blocks) -> DataFrame:
    return blocks.compare(_count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n_neighbours"))


def eps_neighbours(points: DataFrame, columns: list[str], eps: float) -> DataFrame:
    """Coordinates and neighbour count (itself included) of every distinct point."""
    indexed = _indexed(points, columns)
    return indexed.join(_counts(Blocks(indexed, eps)), "id").select(*columns, "n_neighbours")


def dbscan(df: DataFrame, columns: list[str], eps: float, min_points: int, label: str = "label") -> DataFrame:
    """Every row of df with its cluster, as `dbscan.dbscan` labels them."""
    indexed = _indexed(distinct_features(df, columns), columns)
    blocks = Blocks(indexed, eps)
    marked = cut_lineage(_counts(blocks).select("id", (F.col("n_neighbours") >= min_points).alias("core")))
    places = blocks.blocks.select("block", F.posexplode("ids").alias("place", "id")).join(marked, "id")
    flags = places.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "core"))).alias("f")).select(
        "block", F.col("f.core").alias("flags"))  # BLOCK at most
    links = cut_lineage(blocks.compare(_link, "u bigint, v bigint, border boolean", flags).distinct())
    core = marked.where("core").select(F.col("id").alias("node"))
    roots = cut_lineage(connected_components(core, links.where("not border").select("u", "v")))
    borders = links.where("border").join(roots.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("root"))
    numbered = with_rank(roots.select("root").distinct(), ["root"], "cluster")
    clustered = indexed.join(roots.union(borders).withColumnRenamed("node", "id"), "id", "left").join(numbered, "root", "left")
    return label_rows(df, clustered.select("id", *columns, "cluster"), indexed.count(), columns, label)
