"""Map series: legend values, points per series, series statistics and the map centre."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.operators.features import numeric


def distinct_legends(df: DataFrame, legend: str) -> DataFrame:
    return df.select(legend).distinct()


def _text(name: str | None) -> Column:
    """Label or legend as text; a missing column or a null is ''."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name else F.lit("")


def map_points(df: DataFrame, lon: str, lat: str, label: str | None = None, legend: str | None = None) -> DataFrame:
    """Long form (series, lon, lat, label); a null coordinate is an error."""
    return df.select(_text(legend).alias("series"), numeric(df, lon).alias("lon"), numeric(df, lat).alias("lat"),
                     _text(label).alias("label"))


def series_stats(points: DataFrame) -> DataFrame:
    """Per-series statistics; partial sums keep a hot series cheap."""
    return points.groupBy("series").agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in ("lon", "lat")
          for name, f in (("avg", F.avg), ("min", F.min), ("max", F.max))],
        F.count(F.when(F.col("label") != "", 1)).alias("n_labels"))


def map_center(points: DataFrame) -> DataFrame:
    """Unweighted mean of the per-series means."""
    means = points.groupBy("series").agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"))
    return means.agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.count("*").alias("n_series"))
