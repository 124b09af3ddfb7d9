"""Feature columns: numeric coercion, null refusal, distinct tuples, label join-back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.session import cut_lineage


def numeric(df: DataFrame, name: str) -> Column:
    """Any integer or float column as double; another type or a null is an error."""
    if not isinstance(df.schema[name].dataType, T.NumericType):
        raise TypeError(f"column {name} is not numeric")
    col = F.col(name)
    return F.when(col.isNull(), F.raise_error(F.lit(f"null in numeric column {name}")).cast("double")).otherwise(
        col.cast("double"))


def features(df: DataFrame, columns: list[str]) -> DataFrame:
    if not columns:
        raise ValueError("at least one feature column is needed")
    return df.select(*[numeric(df, c).alias(c) for c in columns])


def distinct_features(df: DataFrame, columns: list[str]) -> DataFrame:
    return features(df, columns).distinct()


def project(df: DataFrame, columns: list[str], *optional: str | None) -> DataFrame:
    """The named columns plus those optional ones that are given."""
    return df.select(*columns, *[c for c in optional if c])


def label_join_back(df: DataFrame, labels: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """Every row of df with the label of its feature tuple.

    `labels` holds one row per tuple, so a tuple shared by many rows skews only
    the df side of the join, which AQE splits.
    """
    right = labels.select(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(columns)], label)
    same = reduce(Column.__and__, [numeric(df, c) == F.col(f"_f{i}") for i, c in enumerate(columns)])
    return df.join(right, same).select(*[df[c] for c in df.columns], label)


def with_rank(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Add the 0-based position of each row in the order of `columns`, without a single-task sort.

    Rows are range-partitioned and sorted per partition. The checkpoint pins
    the partitions, so the position in the partition plus the rows of the
    partitions before it is stable. The driver sees one count per partition.
    """
    pinned = cut_lineage(df.repartitionByRange(*columns).sortWithinPartitions(*columns)
                         .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    sizes = pinned.groupBy(part.alias("_part")).count().collect()
    before, offsets = 0, []
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], before))
        before += row["count"]
    if not offsets:
        return pinned.withColumn(name, F.col("_at")).drop("_at")
    starts = df.sparkSession.createDataFrame(offsets, "_part BIGINT, _start BIGINT")
    return (pinned.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_part", "_start", "_at"))
