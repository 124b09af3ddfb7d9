"""Catalog listings and table metadata as DataFrames."""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c.name,) for c in spark.catalog.listCatalogs()], "catalog STRING")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d.catalog, d.name) for d in spark.catalog.listDatabases()],
                                 "catalog STRING, database STRING")


EXPIRES = "lakekit.expires_epoch"  # table property: the epoch second at which the table may go


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database with type, location, creation and expiry (null: never) as epoch seconds.

    One listing command answers for all tables; its text is taken apart as a DataFrame.
    """
    shown = spark.sql(f"SHOW TABLE EXTENDED IN {database} LIKE '*'").where("NOT isTemporary")

    def part(label: str) -> Column:
        return F.nullif(F.regexp_extract("information", rf"(?m)^{label}: (.*)$", 1), F.lit(""))

    created = F.to_timestamp(F.substring(part("Created Time"), 5, 40), "MMM dd HH:mm:ss z yyyy")
    return shown.select(
        F.col("namespace").alias("database"), F.col("tableName").alias("table_name"), part("Type").alias("table_type"),
        part("Created Time").alias("created"), part("Location").alias("location"),
        F.unix_timestamp(created).alias("created_epoch"),
        F.nullif(F.regexp_extract(part("Table Properties"), re.escape(EXPIRES) + r"=(\d+)", 1), F.lit("")).cast("bigint").alias("expires_epoch"))


def expired_tables(spark: SparkSession, database: str, now: int) -> DataFrame:
    """The listed tables whose expiry has come at the epoch second `now`."""
    return list_tables(spark, database).where(F.col("expires_epoch") <= now)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The whole table; pages are the engine's business and never cut it short."""
    return spark.table(name)


def flatten_schema(schema: T.StructType) -> list[tuple[str, str, str, str]]:
    """(path, type, mode, description) per column, records followed by their fields."""
    rows: list[tuple[str, str, str, str]] = []

    def walk(field: T.StructField, prefix: str) -> None:
        kind, mode = field.dataType, "NULLABLE" if field.nullable else "REQUIRED"
        if isinstance(kind, T.ArrayType):
            kind, mode = kind.elementType, "REPEATED"
        path = prefix + field.name
        rows.append((path, "RECORD" if isinstance(kind, T.StructType) else kind.simpleString(), mode,
                     field.metadata.get("comment")))
        if isinstance(kind, T.StructType):
            for child in kind.fields:
                walk(child, path + ".")

    for field in schema.fields:
        walk(field, "")
    return rows


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(flatten_schema(schema), "path STRING, type STRING, mode STRING, description STRING")


def _field(name: str, record):
    return record[name]


def leaf_fill(df: DataFrame) -> DataFrame:
    """Values held at each column path, elements of repeated columns counted one by one."""

    def held(value, kind, path):
        if isinstance(kind, T.ArrayType):
            yield path, F.size(F.filter(value, lambda x: x.isNotNull()))
            for f in getattr(kind.elementType, "fields", []):
                inner = F.transform(value, partial(_field, f.name))
                yield path + "." + f.name, F.size(F.filter(inner, lambda x: x.isNotNull()))
        else:
            yield path, F.when(value.isNotNull(), 1)
            for f in getattr(kind, "fields", []):
                yield from held(value[f.name], f.dataType, path + "." + f.name)

    found = [pair for f in df.schema.fields for pair in held(F.col(f"`{f.name}`"), f.dataType, f.name)]
    totals = df.agg(*[F.coalesce(F.sum(expr.cast("long")), F.lit(0)).alias(f"_{i}") for i, (_, expr) in enumerate(found)])
    pairs = F.array(*[F.struct(F.lit(path).alias("path"), F.col(f"_{i}").alias("n_values"))
                      for i, (path, _) in enumerate(found)])
    return totals.select(F.inline(pairs))
