import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakekit.operators import components, dbscan, kmeans, metric, neighbours, silhouette, silhouette_bounds
from lakekit.session import scratch_path


def brute_counts(points, eps):
    limit = eps * eps
    return {p: sum(sum((a - b) * (a - b) for a, b in zip(p, q)) <= limit for q in points) for p in points}


def brute_dbscan(rows, eps, min_points):
    points = sorted(set(rows))
    limit = eps * eps
    near = {p: [q for q in points if sum((a - b) * (a - b) for a, b in zip(p, q)) <= limit] for p in points}
    core = [p for p in points if len(near[p]) >= min_points]
    is_core, cluster, number = set(core), {}, 0
    for p in core:
        if p in cluster:
            continue
        stack = [p]
        while stack:
            x = stack.pop()
            if x in cluster:
                continue
            cluster[x] = number
            stack += [q for q in near[x] if q in is_core and q not in cluster]
        number += 1
    label, noise = {}, len(points) + 1
    for p in points:
        touching = [cluster[q] for q in near[p] if q in is_core]
        if p in is_core:
            label[p] = cluster[p]
        elif touching:
            label[p] = min(touching)
        else:
            label[p], noise = noise, noise + 1
    return label


def scatter(seed, d, n_blobs, per_blob, spread, noise):
    rng = random.Random(seed)
    rows = []
    for _ in range(n_blobs):
        centre = [rng.uniform(-5, 5) for _ in range(d)]
        rows += [tuple(c + rng.gauss(0, spread) for c in centre) for _ in range(per_blob)]
    rows += [tuple(rng.uniform(-6, 6) for _ in range(d)) for _ in range(noise)]
    return rows + rng.choices(rows, k=20)


CASES = [(1, 1, 3, 40, 0.2, 20, 0.15, 4), (2, 2, 4, 60, 0.3, 60, 0.25, 5), (3, 3, 3, 60, 0.4, 40, 0.5, 5), (4, 4, 2, 40, 0.3, 20, 0.8, 4)]


@pytest.mark.parametrize("seed, d, n_blobs, per_blob, spread, noise, eps, min_points", CASES)
def test_dbscan_matches_brute_force(spark, seed, d, n_blobs, per_blob, spread, noise, eps, min_points):
    rows = scatter(seed, d, n_blobs, per_blob, spread, noise)
    columns = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame(rows, columns)
    got = [(tuple(r)[:d], r.label) for r in dbscan.dbscan(df, columns, eps, min_points).collect()]
    want = brute_dbscan(rows, eps, min_points)
    assert sorted(got) == sorted((p, want[p]) for p in rows)


@pytest.mark.parametrize("seed", [11, 12])
def test_crowded_cells_are_cut_exactly(spark, monkeypatch, seed):
    """Most points sit in a few cells, with the thresholds lowered so every refinement path runs."""
    monkeypatch.setattr(neighbours, "LEAF", 4)
    monkeypatch.setattr(dbscan, "PAIR_WORK", 6)
    rng = random.Random(seed)
    rows = [(rng.uniform(0, 0.6), rng.uniform(0, 0.6)) for _ in range(250)]
    rows += [(rng.uniform(1.5, 1.9), rng.uniform(0, 0.3)) for _ in range(150)]
    rows += [(0.6 + 0.9 * i / 5, 0.1) for i in range(6)] + [(rng.uniform(-4, 4), rng.uniform(-4, 4)) for _ in range(40)]
    df = spark.createDataFrame(rows, ["a", "b"])
    eps = 0.5
    counts = neighbours.eps_neighbours(df.distinct(), ["a", "b"], eps).collect()
    assert {(r.a, r.b): r.n_neighbours for r in counts} == brute_counts(set(rows), eps)
    for min_points in (4, 30):
        want = brute_dbscan(rows, eps, min_points)
        got = dbscan.dbscan(df, ["a", "b"], eps, min_points).collect()
        assert sorted(((r.a, r.b), r.label) for r in got) == sorted((p, want[p]) for p in rows)


def test_border_distance_counts(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (3.5, 0.0)], ["a", "b"])
    got = {(r.a): r.n_neighbours for r in neighbours.eps_neighbours(df, ["a", "b"], 1.0).collect()}
    assert got == {0.0: 2, 1.0: 3, 2.0: 2, 3.5: 1}


def test_only_noise(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (20.0,), (10.0,)], ["a"])
    got = sorted((r.a, r.label) for r in dbscan.dbscan(df, ["a"], 1.0, 2).collect())
    assert got == [(0.0, 4), (10.0, 5), (10.0, 5), (20.0, 6)]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    nodes = sorted({x for e in edges for x in e} | {999})
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    got = components.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node bigint"), spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {r.node: r.root for r in got.collect()} == {n: find(n) for n in nodes}


def test_kmeans_well_separated(spark):
    df = spark.createDataFrame([(10.0, 10.0), (0.0, 0.0), (0.0, 1.0), (10.0, 11.0), (0.0, 0.0)], ["a", "b"])
    model = kmeans.fit(df, ["a", "b"], 2, seeds=(1, 2, 3))
    assert model.summary.trainingCost == pytest.approx(1.0)
    assert kmeans.centroids(model) == [(0.0, 0.5), (10.0, 10.5)]
    got = sorted((r.a, r.b, r.label) for r in kmeans.predict(df, ["a", "b"], model).collect())
    assert got == [(0.0, 0.0, 0), (0.0, 0.0, 0), (0.0, 1.0, 0), (10.0, 10.0, 1), (10.0, 11.0, 1)]
    again = kmeans.load(kmeans.save(model, scratch_path(spark, "model")))
    assert kmeans.predict(df, ["a", "b"], again).orderBy("a", "b").collect() == kmeans.predict(df, ["a", "b"], model).orderBy("a", "b").collect()
    assigned = kmeans.assign(df, ["a", "b"], kmeans.centroids(model)).orderBy("a", "b").collect()
    assert [r.label for r in assigned] == [0, 0, 0, 1, 1]


def test_silhouettes(spark, monkeypatch):
    monkeypatch.setattr(silhouette, "BLOCK", 16)  # several blocks
    rng = random.Random(3)
    rows = [(rng.gauss(c, 1), rng.gauss(-c, 1), c) for c in (0, 3, 6) for _ in range(30)] + [(50.0, 50.0, 9)]
    df = spark.createDataFrame(rows, ["a", "b", "label"])

    def brute(dist):
        total = 0.0
        for i, p in enumerate(rows):
            by = {}
            for j, q in enumerate(rows):
                if i != j:
                    by.setdefault(q[2], []).append(dist(p, q))
            if p[2] not in by:
                continue
            a = sum(by[p[2]]) / len(by[p[2]])
            b = min(sum(v) / len(v) for k, v in by.items() if k != p[2])
            total += (b - a) / max(a, b)
        return total / len(rows)

    exact = silhouette.silhouette_exact(df, ["a", "b"]).first()
    assert exact.n_points == len(rows)
    assert exact.silhouette == pytest.approx(brute(lambda p, q: math.dist(p[:2], q[:2])))
    squared = silhouette.silhouette_squared(df, ["a", "b"])
    assert squared == pytest.approx(brute(lambda p, q: math.dist(p[:2], q[:2]) ** 2))


def test_cells_meet_in_the_dimensions_that_part_them(spark):
    """The first three of six columns are constant: buckets over those would pair every cell with every other."""
    rng = random.Random(5)
    rows = [(1.0, 2.0, 3.0, rng.uniform(0, 20), rng.uniform(0, 20), rng.uniform(0, 20)) for _ in range(400)]
    columns = [f"x{i}" for i in range(6)]
    grid = neighbours.Grid(columns, 1.0)
    cells = neighbours.cell_table(neighbours.index_points(spark.createDataFrame(rows, columns), grid), grid)
    dims = neighbours.hash_dims(cells, grid)
    assert dims == [3, 4, 5]
    index = [neighbours._coarse(grid, i).alias(f"g{i}") for i in dims]
    boxes = [tuple(r) for r in cells.select(*index).collect()]
    met = sum(all(abs(a - b) <= 1 for a, b in zip(x, y)) for x in boxes for y in boxes)
    kept = neighbours.cell_pairs(cells, grid).count()
    assert kept <= met <= 8 * kept
    got = neighbours.eps_neighbours(spark.createDataFrame(rows, columns), columns, 1.0)
    assert {tuple(r)[:6]: r.n_neighbours for r in got.collect()} == brute_counts(rows, 1.0)


def test_depth_is_bounded():
    neighbours.too_deep(neighbours.MAX_DEPTH)
    with pytest.raises(RuntimeError):
        neighbours.too_deep(neighbours.MAX_DEPTH + 1)


def tall(seed, d, per_blob=30, blobs=5, noise=30):
    """Tight groups in d dimensions, on a grid of exact decimals, far from each other and from the noise."""
    rng = random.Random(seed)
    rows = []
    for _ in range(blobs):
        centre = [rng.uniform(-5, 5) for _ in range(d)]
        rows += [tuple(round(c + rng.gauss(0, 0.05), 4) for c in centre) for _ in range(per_blob)]
    rows += [tuple(round(rng.uniform(-6, 6), 4) for _ in range(d)) for _ in range(noise)]
    return rows + rng.choices(rows, k=20)


@pytest.mark.parametrize("seed, d, eps, block, pivots", [(1, 64, 0.6, 128, 16), (2, 64, 0.55, 8, 5), (3, 12, 0.22, 16, 16), (4, 2, 0.2, 4, 3), (5, 1, 0.05, 7, 1)])
def test_pivots_match_brute_force(spark, monkeypatch, seed, d, eps, block, pivots):
    monkeypatch.setattr(metric, "BLOCK", block)
    monkeypatch.setattr(metric, "PIVOTS", pivots)
    rows = tall(seed, d)
    columns = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["k", *columns]).repartition(3)
    found = metric.eps_neighbours(df.select(columns).distinct(), columns, eps).collect()
    want = brute_counts(sorted(set(rows)), eps)
    assert {tuple(r[c] for c in columns): r.n_neighbours for r in found} == want
    assert 1 < max(want.values()) and min(want.values()) == 1
    labels = {r.k: r.label for r in metric.dbscan(df, columns, eps, 5).select("k", "label").collect()}
    expected = brute_dbscan(rows, eps, 5)
    assert labels == {k: expected[r] for k, r in enumerate(rows)}


def test_pivots_compare_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(metric, "BLOCK", 32)
    rows = sorted(set(tall(7, 64, per_blob=200, blobs=12)))
    columns = [f"c{i}" for i in range(64)]
    points = metric._indexed(spark.createDataFrame(rows, columns), columns)
    blocks = metric.Blocks(points, 0.6)
    neighbours_found = metric._counts(blocks).agg(F.sum("n_neighbours")).first()[0]
    assert blocks.candidates() < len(rows) ** 2 / 8
    assert blocks.candidates() < 2 * neighbours_found


def test_pivots_of_no_and_one_point(spark):
    columns = ["a", "b"]
    empty = spark.createDataFrame([], "a double, b double")
    assert metric.eps_neighbours(empty, columns, 1.0).collect() == [] and metric.dbscan(empty, columns, 1.0, 2).collect() == []
    one = spark.createDataFrame([(1.0, 2.0)], columns)
    assert [r.n_neighbours for r in metric.eps_neighbours(one, columns, 1.0).collect()] == [1]
    assert [r.label for r in metric.dbscan(one, columns, 1.0, 2).collect()] == [2]
    with pytest.raises(ValueError):
        metric.eps_neighbours(one, columns, 0.0)


def test_kmeans_of_two_far_pairs(spark):
    points = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (10.0, 10.0), (10.0, 11.0)] * 3, ["a", "b"])
    model = kmeans.fit(points, ["a", "b"], 2, seeds=(42, 43, 44))
    assert model.summary.trainingCost == pytest.approx(1.0)
    assert {(r.a, r.label) for r in kmeans.predict(points, ["a", "b"], model).collect()} == {(0.0, 0), (10.0, 1)}


def _blobs(centres, each, seed, d=2):
    rng = random.Random(seed)
    return sorted({(*[rng.gauss(c, 1) for c in centre[:d]], k) for k, centre in enumerate(centres) for _ in range(each)})


def _silhouette(rows):
    xs, labels = np.array([r[:-1] for r in rows]), np.array([r[-1] for r in rows])
    distance = np.sqrt(((xs[:, None] - xs[None]) ** 2).sum(axis=2))
    found = []
    for i, own in enumerate(labels):
        means = {k: distance[i, labels == k].sum() / max((labels == k).sum() - (k == own), 1) for k in set(labels)}
        other = min([m for k, m in means.items() if k != own], default=None)
        alone = (labels == own).sum() < 2 or other is None
        found.append(0.0 if alone or max(means[own], other) == 0 else (other - means[own]) / max(means[own], other))
    return float(np.mean(found))


@pytest.mark.parametrize("width", [0.3, 0.05, 0.002])
def test_silhouette_bounds_hold_the_score(spark, monkeypatch, width):
    monkeypatch.setattr(silhouette_bounds, "BLOCK_LEVEL", 1)  # many blocks, several levels
    rows = _blobs([(0, 0, 0), (6, 0, 3), (0, 7, 1), (40, 40, 40)], 60, 7, 3) + [(90.0, 90.0, 90.0, 9)]
    found = silhouette_bounds.silhouette_bounds(spark.createDataFrame(rows, ["a", "b", "c", "label"]), ["a", "b", "c"], width=width).first()
    exact = _silhouette(rows)
    assert found.n_points == len(rows)
    assert found.low - 1e-9 <= exact <= found.high + 1e-9
    assert found.high - found.low <= width


def test_silhouette_bounds_open_far_fewer_nodes_than_pairs(spark):
    rows = _blobs([(0, 0), (9, 0), (0, 9), (9, 9)], 2000, 11)
    trees = silhouette_bounds.Trees(spark.createDataFrame(rows, ["a", "b", "label"]), ["a", "b"], "label")
    taken, met = silhouette_bounds._accepted(trees, 0.3)
    blocks = trees.blocks.count()
    whole = taken.groupBy("block", "cluster", "size").agg(F.sum("n").alias("n"))
    assert whole.where("n <> size").isEmpty()  # each point once
    assert taken.count() < blocks * len(rows) / 10
    assert len(met) <= trees.depth + 1
    found = silhouette_bounds.bounds_of(trees, 0.3).first()
    assert found.low <= _silhouette(rows) <= found.high and found.high - found.low <= 0.01


def test_silhouette_bounds_of_odd_tables(spark):
    schema = "a double, b double, label bigint"
    empty = silhouette_bounds.silhouette_bounds(spark.createDataFrame([], schema), ["a", "b"]).first()
    assert (empty.low, empty.high, empty.n_points) == (None, None, 0)
    one = silhouette_bounds.silhouette_bounds(spark.createDataFrame([(1.0, 2.0, 4), (3.0, 2.0, 4)], schema), ["a", "b"]).first()
    assert (one.low, one.high, one.n_points) == (0.0, 0.0, 2)  # a single cluster
    flat = [(1.0, float(k), k % 2) for k in range(40)]  # a constant column
    found = silhouette_bounds.silhouette_bounds(spark.createDataFrame(flat, schema), ["a", "b"]).first()
    assert found.low - 1e-9 <= _silhouette(flat) <= found.high + 1e-9


@pytest.mark.parametrize("seed, d, eps, shift", [(6, 64, 0.6, 0.0), (7, 12, 0.25, 0.0), (8, 8, 0.6, 1e6)])
def test_tiles_move_points_a_fixed_number_of_times(spark, monkeypatch, seed, d, eps, shift):
    """Blocks are sent once a tile they can meet, however many blocks are there; far from the origin products settle nothing."""
    for name, value in (("BLOCK", 4), ("TILES", 3)):
        monkeypatch.setattr(metric, name, value)
    rows = [tuple(x + shift for x in r) for r in tall(seed, d)]
    columns = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["k", *columns])
    blocks = metric.Blocks(metric._indexed(df.select(columns).distinct(), columns), eps)
    assert len(blocks.cells) <= 6 < blocks.blocks.count()
    found = neighbours.eps_neighbours(df.select(columns).distinct(), columns, eps)
    assert {tuple(r[c] for c in columns): r.n_neighbours for r in found.collect()} == brute_counts(sorted(set(rows)), eps)
    labels = {r.k: r.label for r in dbscan.dbscan(df, columns, eps, 5).select("k", "label").collect()}
    expected = brute_dbscan(rows, eps, 5)
    assert labels == {k: expected[r] for k, r in enumerate(rows)}


def test_products_settle_only_what_rounding_cannot_turn():
    rng = np.random.default_rng(4)
    for points, eps in ((rng.normal(size=(60, 64)), 11.0), (rng.integers(0, 3, (60, 5)).astype(float), math.sqrt(5)), (rng.normal(size=(60, 3)) * 1e200, 1e200)):
        cell = object.__new__(metric.Cell)
        with np.errstate(all="ignore"):
            cell.points, cell.squares = points, (points * points).sum(axis=1)
            cell.left, cell.right = np.column_stack([-2 * points, np.ones(60)]), np.column_stack([points, cell.squares])
            assert (cell.near(np.arange(20), np.arange(20, 60), eps) == metric.near_matrix(points[:20], points[20:], eps)).all()


def test_roots_of_chains_and_of_nothing():
    links = [(k + 1, k) for k in range(9)] + [(12, 15)]
    u, v = np.array(links).T
    assert metric._roots(np.arange(17), u, v).tolist() == [0] * 10 + [10, 11, 12, 13, 14, 12, 16]
    assert metric._roots(np.arange(2), u[:0], v[:0]).tolist() == [0, 1]


@pytest.mark.parametrize("chunk, edges, tiles", [(5, 3, 1), (4096, 1 << 20, 2), (7, 20, 2)])
def test_a_cell_links_its_core_points(monkeypatch, chunk, edges, tiles):
    monkeypatch.setattr(metric, "CHUNK", chunk)
    monkeypatch.setattr(metric, "EDGES", edges)
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.3, (24, 2)) for c in (0, 4)] + [rng.uniform(-2, 6, (16, 2))])
    core, size, eps = rng.random(64) < 0.8, 8, 0.7
    second = np.arange(8) * tiles // 8
    away = metric.to_pivots(points, points[:2]).reshape(8, size, 2)
    lists = lambda x: pa.array(list(x.reshape(8, -1)))
    table = pa.table({"home": np.zeros(8, np.int32), "n": np.full(8, size, np.int32), "second": second, "ids": lists(np.arange(64)), "flags": lists(core),
                      "vectors": [points[a:a + size].tobytes() for a in range(0, 64, size)], "low": lists(away.min(axis=1) * 0), "high": lists(away.max(axis=1))})
    found = pa.Table.from_batches(list(metric._link(metric.Cell(table, 2, 2), eps)))
    hits = metric.near_matrix(points, points, eps)
    of = second[np.arange(64) // size]
    if tiles == 2:  # a cell of two tiles holds only pairs across
        hits &= of[:, None] != of[None, :]
    links = found.to_pylist()
    borders = sorted((r["u"], r["v"]) for r in links if r["border"])
    assert borders == sorted((i, j) for i, j in zip(*hits.nonzero()) if not core[i] and core[j])
    want = metric._roots(np.arange(64), *(hits & core[:, None] & core[None, :]).nonzero())
    got = metric._roots(np.arange(64), *(np.array([r[c] for r in links if not r["border"]], int) for c in "uv"))
    assert (got == want).all()
