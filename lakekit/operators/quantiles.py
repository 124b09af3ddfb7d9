"""Exact quantiles by selection: counts of ranges, then only the range that holds the rank.

A group's values are never gathered, sorted or kept as a map. Each round cuts the values still in question at CUTS approximate quantiles
(a sketch of bounded size), counts what lies at and between the cuts exactly, and goes on with the one range that holds the
rank asked for. A round leaves about one CUTS-th of the rows, so the rounds after the first cost little; a value equal to a cut is a range of its
own, so hot values end the search at once. Once a range holds LEAF rows at most, they are numbered in order.

All counts are partial sums before the shuffle, so a group may hold any share of the table. Nulls are left out; NaN is greatest. A group without
values has null quantiles. Null group keys are a group. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakekit.session import cut_lineage

CUTS = 15
LEAF = 10_000
FEW = 200_000  # groups or targets that may be broadcast


def _with(rows: DataFrame, few: DataFrame, by: list[str]) -> DataFrame:
    return rows.join(F.broadcast(few) if few.count() <= FEW else few, by)


def _ranges(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows with `b`, the range of their value: even numbers lie between cuts, odd ones are cuts."""
    grid = [k / (CUTS + 1) for k in range(1, CUTS + 1)]
    cuts = cut_lineage(rows.groupBy(*by).agg(F.array_distinct(F.percentile_approx("v", grid, 1000)).alias("cuts")))
    below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    return _with(rows, cuts, by).withColumn("b", 2 * below + F.array_contains("cuts", F.col("v")).cast("int")).drop("cuts")


def select_ranks(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(g, rank, v): the value at each 0-based `rank` of group `g`, given rows (g, v) and targets (g, rank)."""
    found, by = [], ["g"]
    targets = cut_lineage(targets.withColumn("left", F.col("rank")))
    while True:
        ranged = _ranges(rows, by)
        counts = ranged.groupBy(*by, "b").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        before = W.partitionBy(*by).orderBy("b").rowsBetween(W.unboundedPreceding, -1)  # 2 * CUTS + 1 rows at most
        placed = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        held = cut_lineage(targets.join(placed, by).where("left >= before and left < before + n").select(
            "g", "rank", (F.col("left") - F.col("before")).alias("left"), "b", "n", "lo", "hi"))
        found.append(held.where("lo <=> hi").select("g", "rank", F.col("lo").alias("v")))
        targets = held.where("not lo <=> hi")
        most = targets.agg(F.max("n")).first()[0]
        if most is None:
            break
        rows = cut_lineage(_with(ranged, targets.select("g", "rank", "b"), [*by, "b"]).select("g", "rank", "v"))
        targets, by = targets.select("g", "rank", "left"), ["g", "rank"]
        if most <= LEAF:
            order = W.partitionBy("g", "rank").orderBy("v")
            numbered = rows.withColumn("at", F.row_number().over(order) - 1)
            found.append(numbered.join(targets, by).where("at = left").select("g", "rank", "v"))
            break
    return reduce(DataFrame.unionByName, found)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, fractions: list[float]) -> DataFrame:
    """Per group the keys, n (values that aren't null) and `quantiles`, one for each fraction, interpolated between neighbours."""
    counts = df.groupBy(*keys).agg(F.count(value).alias("n"))
    groups = cut_lineage(counts.withColumn("g", F.monotonically_increasing_id()))
    same = reduce(lambda a, b: a & b, (df[k].eqNullSafe(groups[k]) for k in keys), F.lit(True))
    filled = df.where(F.col(value).isNotNull())
    rows = filled.join(F.broadcast(groups) if groups.count() <= FEW else groups, same).select("g", F.col(value).cast("double").alias("v"))
    places = groups.where("n > 0").select("g", F.posexplode(F.array(*(F.lit(float(f)) for f in fractions))).alias("q", "f"), "n").select(
        "g", "q", ((F.col("n") - 1) * F.col("f")).alias("place"))
    places = cut_lineage(places.select("g", "q", F.floor("place").alias("low"), F.ceil("place").alias("high"), (F.col("place") - F.floor("place")).alias("part")))
    ranks = places.select("g", F.explode(F.array("low", "high")).alias("rank")).distinct()
    values = cut_lineage(select_ranks(rows, ranks))
    both = places.join(values.toDF("g", "low", "a"), ["g", "low"]).join(values.toDF("g", "high", "b"), ["g", "high"])
    each = both.select("g", "q", (F.col("a") + F.when(F.col("part") > 0, (F.col("b") - F.col("a")) * F.col("part")).otherwise(F.lit(0.0))).alias("v"))
    lists = each.groupBy("g").agg(F.transform(F.sort_array(F.collect_list(F.struct("q", "v"))), lambda x: x["v"]).alias("quantiles"))
    return groups.join(lists, "g", "left").select(*keys, "n", "quantiles")
