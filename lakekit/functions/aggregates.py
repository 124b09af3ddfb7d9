"""Newline string aggregation: a column form for SQL-sized groups and a skew-safe operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newline_fold(parts: Column) -> Column:
    """Join an ordered string array: nulls skipped, empties vanish only before the first other text.

    One join over what starts at that text: linear in the total length.
    """
    def join(xs: Column) -> Column:
        first = F.array_position(F.transform(xs, lambda x: F.length(x) > 0), True).cast("int")
        return F.when(first > 0, F.array_join(F.slice(xs, first, F.size(xs)), "\n")).otherwise("")

    # a one-element array binds the filtered texts, so they are computed once
    return F.get(F.transform(F.array(F.array_compact(parts)), join), F.lit(0))


def string_agg_newline(text: Column, *order: Column) -> Column:
    """Aggregate Column: the group's texts in `order`, newline separated; no rows give ''."""
    items = F.sort_array(F.collect_list(F.struct(*order, text.alias("text"))))
    return newline_fold(F.transform(items, lambda e: e["text"]))


def grouped_string_agg(df: DataFrame, keys: list[str], text: str, order: list[str], name: str) -> DataFrame:
    """Skew-safe form: (keys, name) with each group's texts joined in `order`.

    Rows are range-partitioned on keys, order and text, so a hot group is cut into
    consecutive pieces over many tasks. Each task joins its own pieces before
    anything is shuffled again, and the last step only puts one piece per
    partition together. `lead` counts the empty texts a piece starts with: they
    vanish at the start of a group and are separators anywhere else.
    """
    ordered = df.repartitionByRange(*[F.col(c) for c in keys + order + [text]])
    piece = ordered.select(*keys, *order, text).withColumn("_piece", F.spark_partition_id())
    texts = F.transform(
        F.sort_array(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(*order, F.col(text).alias("_text"))))),
        lambda e: e["_text"])
    joined = (
        piece.groupBy(*keys, "_piece").agg(texts.alias("_texts"))
        .withColumn("_body", newline_fold(F.col("_texts")))
        .withColumn("_first", F.array_position(F.transform("_texts", lambda t: F.length(t) > 0), True))
        .withColumn("_lead", F.when(F.col("_first") > 0, F.col("_first") - 1).otherwise(F.size("_texts")).cast("int"))
        .drop("_texts")
    )
    pieces = F.sort_array(F.collect_list(F.struct("_piece", "_lead", "_body")))
    texts = F.flatten(F.transform(pieces, lambda p: F.concat(
        F.array_repeat(F.lit(""), p["_lead"]), F.when(F.length(p["_body"]) > 0, F.array(p["_body"])).otherwise(F.array().cast("array<string>")))))
    return joined.groupBy(*keys).agg(newline_fold(texts).alias(name))
