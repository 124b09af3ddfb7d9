"""Inequality joins, exact quantiles and recursion by doubling against brute force."""

import datetime
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakekit.operators import bands, closure, quantiles
from lakekit import session
from lakekit.plans import catalog, io_queries

SF_DIR = "/root/testdata/sf0.001"


def pairs_brute(points, intervals):
    def number(x):
        return x is not None and not (isinstance(x, float) and math.isnan(x))

    return sorted((p, k) for p, x in points for k, lo, hi in intervals if number(x) and number(lo) and number(hi) and lo <= x <= hi)


@pytest.mark.parametrize("cell, ranges, piece", [(200_000, 64, 1 << 16), (40, 8, 7), (40, 1, 100)])
def test_band_join(spark, monkeypatch, cell, ranges, piece):
    monkeypatch.setattr(bands, "CELL", cell)
    monkeypatch.setattr(bands, "SLICE", piece)
    rng = random.Random(3)
    points = [(i, 5.0 if i % 3 == 0 else round(rng.uniform(0, 100), 1)) for i in range(600)] + [(900, None), (901, float("nan")), (902, float("inf"))]
    intervals = [(k, x, x + rng.choice([0.0, 0.5, 20.0])) for k, x in ((k, round(rng.uniform(-5, 105), 1)) for k in range(200))]
    intervals += [(300, 9.0, 8.0), (301, None, 4.0), (302, 1.0, None), (303, float("nan"), 9.0), (304, 5.0, 5.0), (304, 5.0, 5.0)]
    left = spark.createDataFrame(points, "p long, x double").repartition(3)
    right = spark.createDataFrame(intervals, "k long, lo double, hi double").repartition(2)
    got = bands.band_join(left, right, F.col("x"), F.col("lo"), F.col("hi"), ranges)
    assert sorted((r.p, r.k) for r in got.collect()) == pairs_brute(points, intervals)
    above = bands.band_join(left, right, F.col("x"), F.col("lo"), None, ranges)
    assert sorted((r.p, r.k) for r in above.collect()) == pairs_brute(points, [(k, lo, math.inf) for k, lo, _ in intervals])
    none = bands.band_join(left, right.limit(0), F.col("x"), F.col("lo"), F.col("hi"))
    assert none.collect() == [] and bands.band_join(left.limit(0), right, F.col("x"), F.col("lo"), F.col("hi")).collect() == []


def test_band_join_of_times_and_wrong_types(spark):
    day = datetime.datetime(2024, 1, 1)
    left = spark.createDataFrame([(i, day + datetime.timedelta(microseconds=i)) for i in range(50)], "p long, at timestamp")
    right = spark.createDataFrame([(1, day + datetime.timedelta(microseconds=10))], "k long, mid timestamp_ntz")
    got = bands.band_join(left, right, F.col("at"), F.col("mid"), F.col("mid") + F.expr("INTERVAL '0.000003' SECOND"))
    assert sorted(r.p for r in got.collect()) == [10, 11, 12, 13]
    big = spark.createDataFrame([(2**53 + 1,), (2**53,)], "n long")
    assert [r.n for r in bands.band_join(big, spark.createDataFrame([(2**53 + 1,)], "m long"), F.col("n"), F.col("m"), F.col("m")).collect()] == [2**53 + 1]
    with pytest.raises(TypeError):
        bands.band_join(left, right, F.col("p"), F.col("mid"), F.col("mid"))
    with pytest.raises(TypeError):
        bands.band_join(left.withColumn("s", F.lit("x")), right, F.col("s"), F.col("k"), F.col("k"))
    with pytest.raises(ValueError):
        bands.band_join(left, left, F.col("at"), F.col("at"), F.col("at"))


def test_a_hot_range_is_many_cells(spark, monkeypatch):
    monkeypatch.setattr(bands, "CELL", 100)
    left = spark.createDataFrame([(i, 7) for i in range(1000)] + [(2000 + i, i) for i in range(100)], "p long, x long")
    right = spark.createDataFrame([(k, 7, 7) for k in range(300)], "k long, lo long, hi long")
    joined = bands.band_join(left, right, F.col("x"), F.col("lo"), F.col("hi"))
    assert joined.count() == 1001 * 300 and joined.select("p", "k").distinct().count() == 1001 * 300
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("cell, ranges", [(200_000, 64), (40, 8), (7, 1)])
def test_band_sums_make_no_pairs(spark, monkeypatch, cell, ranges):
    monkeypatch.setattr(bands, "CELL", cell)
    rng = random.Random(5)
    points = [(5.0 if k % 3 == 0 else round(rng.uniform(0, 100), 1), None if k % 4 == 0 else k / 8) for k in range(600)]
    points += [(None, 1.0), (float("nan"), 1.0), (float("inf"), 2.0), (200.0, None), (300.0, float("nan")), (301.0, 1e300), (302.0, 1.0)]
    intervals = [(k % 150, x, x + rng.choice([0.0, 0.5, 20.0, 90.0])) for k, x in ((k, round(rng.uniform(-5, 105), 1)) for k in range(200))]
    intervals += [(500, 9.0, 8.0), (501, None, 4.0), (503, float("nan"), 9.0), (504, 150.0, 250.0), (505, 299.0, 300.0), (506, 302.0, 400.0), (None, 0.0, 100.0)]
    left = spark.createDataFrame(points, "x double, v double").repartition(3)
    right = spark.createDataFrame(intervals, "k long, lo double, hi double").repartition(2)
    joined = bands.band_join(left, right, F.col("x"), F.col("lo"), F.col("hi"), ranges, sums=["v"])
    want = []
    for k, lo, hi in intervals:
        held = [v for x, v in points if None not in (x, lo, hi) and lo <= x <= hi]
        if held:
            some = [v for v in held if v is not None]
            want.append((k, lo, hi, len(held), sum(some) if some else None))
    assert sorted(map(repr, map(tuple, joined.collect()))) == sorted(map(repr, want))
    assert bands.band_join(left.limit(0), right, F.col("x"), F.col("lo"), F.col("hi"), sums=["v"]).collect() == []


def test_few_pairs_are_unfolded_at_once():
    """What two explodes make of one row is held in the JVM until the row is done."""
    points = pa.array([{"p": k} for k in range(1000)])
    lists = [r for b in bands._unfolded(points, points, np.zeros(1000, np.int64), np.full(1000, 1000)) for r in b.to_pylist()]
    assert sum(len(r["lefts"]) * len(r["rights"]) for r in lists) == 10**6
    assert max(len(r["lefts"]) * len(r["rights"]) for r in lists) <= 1 << 14


def test_pairs_of_a_range_are_dealt_by_their_number(spark, monkeypatch):
    """Few rows that make many pairs are many tasks."""
    monkeypatch.setattr(bands, "PAIRS", 1000)
    left = spark.createDataFrame([(i, 7) for i in range(300)], "p long, x long")
    right = spark.createDataFrame([(k, 7, 7) for k in range(200)], "k long, lo long, hi long")
    joined = bands.band_join(left, right, F.col("x"), F.col("lo"), F.col("hi"))
    per_task = joined.groupBy(F.spark_partition_id().alias("task")).count()
    sizes = [r["count"] for r in per_task.collect()]
    assert sum(sizes) == 300 * 200 and max(sizes) < 15_000 and len(sizes) > 10


@pytest.mark.parametrize("key", ["join_time_band", "join_price_band", "quantiles_exact", "chain_totals"])
def test_no_product_and_no_percentile_map(spark, key):
    plan = catalog.queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(trait in plan for trait in ("CartesianProduct", "NestedLoop", " percentile(", "RecursiveCTE", "UnionLoop"))


def quantile_brute(values, f):
    place = (len(values) - 1) * f
    low, high = math.floor(place), math.ceil(place)
    part = place - low
    return values[low] + ((values[high] - values[low]) * part if part > 0 else 0.0)


@pytest.mark.parametrize("leaf, cuts", [(10_000, 15), (5, 3), (1, 2)])
def test_exact_quantiles(spark, monkeypatch, leaf, cuts):
    monkeypatch.setattr(quantiles, "LEAF", leaf)
    monkeypatch.setattr(quantiles, "CUTS", cuts)
    rng = random.Random(8)
    rows = [("hot", 3.0 if i % 3 else rng.uniform(-9, 9)) for i in range(900)] + [("even", float(i)) for i in range(400)]
    rows += [("wild", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)) for _ in range(300)]
    rows += [(None, float(i % 7)) for i in range(100)] + [("one", 4.5), ("none", None), ("same", 1.0), ("same", 1.0), ("hot", None)]
    rng.shuffle(rows)
    fractions = [0.0, 0.25, 0.5, 0.901, 1.0]
    got = quantiles.exact_quantiles(spark.createDataFrame(rows, "k string, x double").repartition(4), ["k"], "x", fractions)
    groups = {}
    for k, x in rows:
        groups.setdefault(k, []).extend([] if x is None else [x])
    want = {k: (len(v), [quantile_brute(sorted(v), f) for f in fractions] if v else None) for k, v in groups.items()}
    assert {r.k: (r.n, r.quantiles) for r in got.collect()} == want
    assert quantiles.exact_quantiles(spark.createDataFrame([], "k string, x double"), ["k"], "x", [0.5]).collect() == []


def test_chains(spark):
    step = {i: i - 1 for i in range(1, 130)} | {0: None, 200: 0, 201: 0, 300: 301, 301: 302, 302: 300, 310: 300, 400: 400, 500: 999}
    rows = [(k, v, None if k == 7 else k) for k, v in step.items()] + [(None, 3, 5)]

    def walk(k):
        seen, total = [], 0
        while True:
            if k in seen:
                return None, None, None
            seen.append(k)
            total += 0 if k == 7 else k
            if step[k] is None or step[k] not in step:
                return k, len(seen) - 1, total
            k = step[k]

    got = closure.follow_chains(spark.createDataFrame(rows, "id long, up long, x long"), "id", "up", "x").collect()
    assert {r.node: (r["last"], r.steps, r.total) for r in got} == {k: walk(k) for k in step} and len(got) == len(step)
    assert closure.follow_chains(spark.createDataFrame([], "id long, up long, x long"), "id", "up", "x").collect() == []


def test_chains_double_their_steps(spark, monkeypatch):
    rounds = []
    real = closure.cut_lineage
    monkeypatch.setattr(closure, "cut_lineage", lambda df: rounds.append(1) or real(df))
    rows = spark.range(1000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"), F.lit(1).alias("x"))
    got = closure.follow_chains(rows, "id", "up", "x")
    assert got.where("total <> node + 1 or last <> 0").count() == 0 and len(rounds) <= 12


def test_reachable(spark):
    rng = random.Random(5)
    edges = {(i, i + 1) for i in range(20)} | {(rng.randrange(30, 50), rng.randrange(30, 50)) for _ in range(25)}
    best = {}
    for start in {u for u, _ in edges}:
        front, steps = {start}, 0
        while front:
            front, steps = {v for u, v in edges if u in front and (start, v) not in best}, steps + 1
            best |= {(start, v): steps for v in front}
    got = closure.reachable(spark.createDataFrame(sorted(edges) + [(1, 2)], "u long, v long"))
    assert {(r.u, r.v): r.steps for r in got.collect()} == best


def test_newline_text_of_a_group_in_pieces(spark, tmp_path, monkeypatch):
    """Empty texts vanish before a group's first other text only, wherever its pieces are cut."""
    rng = random.Random(8)
    rows = [(rng.choice(["A", "N", None]), rng.choice([None, *range(300)]), rng.randrange(4), rng.randrange(9), rng.choice([None, 1, 22]), rng.choice("FO")) for _ in range(900)]
    rows += [("A", -k, 0, 0, 5, "F") for k in range(1, 200)] + [("E", k, 0, 0, 5, "F") for k in range(50)] + [("X", k, 0, 0, None, "O") for k in range(50)]
    names = "l_returnflag string, l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_linestatus string"
    spark.createDataFrame(rows, names).repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    want = {}
    for flag in {r[0] for r in rows}:
        held = [(r[1:4], "" if r[5] == "F" else None if None in (flag, r[4]) else f"{flag}{r[4]}") for r in rows if r[0] == flag]
        held.sort(key=lambda r: ([(x is not None, x or 0) for x in r[0]], r[1] is not None, r[1] or ""))
        texts = [x for _, x in held if x is not None]
        begun = next((k for k, x in enumerate(texts) if x), len(texts))
        want[flag] = (len(held), hashlib.md5("\n".join(texts[begun:]).encode()).hexdigest())
    monkeypatch.setattr(io_queries, "PIECE", 100)
    found = catalog.queries()["sql_newline_agg_large"](spark, str(tmp_path))
    assert {r.l_returnflag: (r.n, r.lines) for r in found.collect()} == want
    assert "rangepartitioning(l_returnflag" in found._jdf.queryExecution().executedPlan().toString()


def test_crlf_files_grow_in_number(spark, tmp_path):
    rows = [(k, f"a \"b\" {k}" * 20, "en") for k in range(2000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8KB")
    try:
        found = catalog.queries()["csv_crlf"](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = next(p for p in reversed(session._SCRATCH) if "crlf" in p) + ".csv"
    assert len(spark.read.format("binaryFile").load(written).select("path").collect()) > 2
    assert {tuple(r) for r in found.collect()} == {(k, t.replace(" ", "\r\n"), lang) for k, t, lang in rows}
