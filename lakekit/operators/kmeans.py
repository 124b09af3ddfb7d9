"""KMeans on distinct feature tuples: fit, predict, save, load, literal centroids."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.operators.features import distinct_features, features, numeric

# Defaults of a fit.
TOLERANCE = 1e-3
MAX_ITERATIONS = 100


def _vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="_features").transform(df)


def fit(df: DataFrame, columns: list[str], k: int, tolerance: float = TOLERANCE, max_iterations: int = MAX_ITERATIONS,
        seeds: tuple[int, ...] = (42,)) -> KMeansModel:
    """Fit on the distinct tuples; of several seeds the cheapest model wins."""
    points = _vectors(distinct_features(df, columns), columns).select("_features").persist()
    try:
        models = [KMeans(k=k, tol=tolerance, maxIter=max_iterations, seed=seed, featuresCol="_features",
                         predictionCol="_cluster").fit(points) for seed in seeds]
    finally:
        points.unpersist()
    return min(models, key=lambda m: m.summary.trainingCost)


def centroids(model: KMeansModel) -> list[tuple[float, ...]]:
    """Cluster centres in coordinate order, which makes label numbers independent of the seed."""
    return sorted(tuple(map(float, c)) for c in model.clusterCenters())


def nearest(columns: list[Column], centres: list[tuple[float, ...]]) -> Column:
    """Index of the nearest centre, the lowest among equals."""
    scored = [F.struct(reduce(add, [(c - F.lit(x)) * (c - F.lit(x)) for c, x in zip(columns, centre)]).alias("d"),
                       F.lit(i).alias("i")) for i, centre in enumerate(centres)]
    return F.array_min(F.array(*scored))["i"]


def assign(df: DataFrame, columns: list[str], centres: list[tuple[float, ...]], label: str = "label") -> DataFrame:
    """Label every row by its nearest centre.

    A tuple's label depends on the tuple alone, so rows are labelled in place
    and need no join back to the distinct tuples.
    """
    return df.withColumn(label, nearest([numeric(df, c) for c in columns], centres))


def predict(df: DataFrame, columns: list[str], model: KMeansModel, label: str = "label") -> DataFrame:
    """Every row of df with its cluster, clusters numbered in coordinate order of their centres."""
    order = {c: i for i, c in enumerate(centroids(model))}
    # equal centres share the first number
    numbers = F.array(*[F.lit(order[tuple(map(float, c))]) for c in model.clusterCenters()])
    raw = df.select("*", *[c.alias(f"_x{i}") for i, c in enumerate([numeric(df, c) for c in columns])])
    out = model.transform(_vectors(raw, [f"_x{i}" for i in range(len(columns))]))
    return out.select(*df.columns, F.get(numbers, F.col("_cluster")).alias(label))


def cluster(df: DataFrame, columns: list[str], k: int, **options) -> DataFrame:
    """Fit and predict in one go."""
    features(df, columns)  # refuses missing or non-numeric columns before any job runs
    return predict(df, columns, fit(df, columns, k, **options))


def save(model: KMeansModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> KMeansModel:
    return KMeansModel.load(path)
