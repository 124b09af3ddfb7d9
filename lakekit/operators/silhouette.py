"""Silhouette scores of labelled distinct points.

The squared-distance score is linear: cluster moments replace all pairs. The
exact score over plain Euclidean distances has no such shortcut, so packed
blocks of points meet block by block inside tasks; no pair of points is ever a
row, and memory per task is two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.features import with_rank
from lakekit.session import cut_lineage

BLOCK = 2048  # points per block


def silhouette_squared(points: DataFrame, columns: list[str], label: str = "label") -> float:
    """Mean silhouette over squared Euclidean distances (one pass over cluster moments)."""
    vectors = VectorAssembler(inputCols=columns, outputCol="_features").transform(points)
    vectors = vectors.select("_features", F.col(label).cast("double").alias("_label"))
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean", featuresCol="_features",
                               predictionCol="_label").evaluate(vectors)


def point_silhouettes(points: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """(columns, label, silhouette) per distinct point; a point alone in its cluster scores 0."""
    ranked = cut_lineage(with_rank(points.select(*columns, F.col(label).cast("long").alias("_label")), columns, "id"))
    packed = cut_lineage(
        ranked.groupBy(F.floor(F.col("id") / BLOCK).cast("long").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("id", "_label", F.array(*columns).alias("x")))).alias("p"))
        .select("block", F.col("p.id").alias("ids"), F.col("p._label").alias("labels"),
                F.flatten(F.col("p.x")).alias("xs")))
    n_blocks = packed.count()
    d = len(columns)
    asking = packed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    given = packed.select(F.col("block").alias("other"), F.col("labels").alias("_labels"), F.col("xs").alias("_xs"))
    met = asking.join(given, "other").select("ids", "xs", "_labels", "_xs")

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a = np.asarray(row.xs, dtype=float).reshape(-1, d)
                b = np.asarray(row[3], dtype=float).reshape(-1, d)
                present, code = np.unique(np.asarray(row[2]), return_inverse=True)
                distance = np.sqrt(sum((a[:, None, i] - b[None, :, i]) ** 2 for i in range(d)))
                member = np.zeros((len(b), len(present)))
                member[np.arange(len(b)), code] = 1.0
                total = distance @ member
                yield pd.DataFrame({
                    "id": np.repeat(np.asarray(row.ids), len(present)), "cluster": np.tile(present, len(a)),
                    "total": total.ravel()})

    partial = met.mapInPandas(sums, "id BIGINT, cluster BIGINT, total DOUBLE")
    totals = partial.groupBy("id", "cluster").agg(F.sum("total").alias("total"))
    sizes = ranked.groupBy(F.col("_label").alias("cluster")).agg(F.count("*").alias("size"))
    own = F.col("cluster") == F.col("_label")
    per_point = totals.join(sizes, "cluster").join(ranked.select("id", "_label"), "id").groupBy("id").agg(
        F.max(F.when(own, F.col("size"))).alias("size"),
        F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"))
    score = F.when((F.col("size") <= 1) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.when(F.greatest("a", "b") == 0, F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b")))
    return ranked.join(per_point.select("id", score.alias("silhouette")), "id").select(
        *columns, F.col("_label").alias(label), "silhouette")


def silhouette_exact(points: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """One row: the mean silhouette over Euclidean distances and the number of points."""
    return point_silhouettes(points, columns, label).agg(
        F.avg("silhouette").alias("silhouette"), F.count("*").alias("n_points"))
