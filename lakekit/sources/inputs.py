"""Register inputs as numbered tables, run SQL over them, describe what is registered."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.sources.csv_records import OPTIONS, read_csv
from lakekit.sources.objects import store_of

# Format by (case-sensitive) file extension.
READ_FORMATS = {"json": "json", "njson": "json", "parquet": "parquet", "csv": "csv"}


class UnsupportedFormat(ValueError):
    """The file extension names no readable or writable format."""


def format_of(path: str, formats: dict[str, str]) -> str:
    extension = os.path.splitext(path.rstrip("/"))[1].lstrip(".")
    if extension not in formats:
        raise UnsupportedFormat(
            f"unsupported file extension in {path!r}: expected one of {', '.join(sorted(formats))}")
    return formats[extension]


def read_input(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One input by extension. Paths and URLs go to the Hadoop connector; a glob is one table.

    A schema given here saves the extra pass that CSV and JSON inference needs. CSV files are cut into records, which may span
    lines and end with LF or CRLF, inside one file; where Arrow has no file system for a URL, a file is one task.
    """
    reader = spark.read
    kind = format_of(path, READ_FORMATS)
    if kind == "csv" and _arrow_reads(path):
        return read_csv(spark, path, schema)
    if kind == "csv":
        reader = reader.options(**OPTIONS).option("header", True).option("inferSchema", schema is None)
    if schema is not None and kind != "parquet":
        reader = reader.schema(schema)
    return reader.format(kind).load(path)


def _arrow_reads(path: str) -> bool:
    try:
        store_of(path)
    except (ValueError, OSError):
        return False
    return True


def register_inputs(spark: SparkSession, paths: list[str], schemas: dict[int, object] | None = None) -> list[str]:
    """Register each path as the temp view `t{position}` and return the view names."""
    names = []
    for i, path in enumerate(paths):
        read_input(spark, path, (schemas or {}).get(i)).createOrReplaceTempView(f"t{i}")
        names.append(f"t{i}")
    return names


def run_query(spark: SparkSession, paths: list[str], text: str, schemas: dict[int, object] | None = None) -> DataFrame:
    """SQL over numbered inputs."""
    register_inputs(spark, paths, schemas)
    return spark.sql(text)


def dry_run(spark: SparkSession, text: str, **tables: DataFrame) -> T.StructType:
    """Result schema of a query; analysis only, no job runs."""
    return spark.sql(text, **tables).schema


def limited(df: DataFrame, n: int, *order) -> DataFrame:
    """Exactly n rows of an ordered result (top-n, no full sort)."""
    return df.orderBy(*order).limit(n)


COLUMNS_SCHEMA = "table_name STRING, column_name STRING, ordinal BIGINT, data_type STRING, is_nullable STRING"


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Column metadata of several tables, one row per column."""
    rows = [
        (name, f.name, i, f.dataType.simpleString(), "YES" if f.nullable else "NO")
        for name, df in tables.items() for i, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def describe_table(spark: SparkSession, name: str = "t0") -> DataFrame:
    """Column, type and nullability of any registered table."""
    return columns_of(spark, {name: spark.table(name)}).select("column_name", "data_type", "is_nullable")


def information_schema_columns(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """The `columns` view over the session's registered tables."""
    if names is None:
        names = [t.name for t in spark.catalog.listTables()]
    return columns_of(spark, {n: spark.table(n) for n in names})


def information_schema_tables(spark: SparkSession) -> DataFrame:
    rows = [(t.namespace[0] if t.namespace else "", t.name, t.tableType, t.isTemporary)
            for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_schema STRING, table_name STRING, table_type STRING, is_temporary BOOLEAN")


def column_fill(df: DataFrame, table_name: str | None = None) -> DataFrame:
    """Non-null values per column in one aggregation pass: (table_name, column_name, n_values)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_values")) for c in df.columns])
    return counts.select(F.lit(table_name).alias("table_name"), F.inline(pairs))
