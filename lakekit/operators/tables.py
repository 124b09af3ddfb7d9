"""Managed tables: create, drop, write dispositions and validated insert."""

from __future__ import annotations

import dataclasses
import datetime
import typing

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.session import scratch_path
from lakekit.sources.catalog import EXPIRES, expired_tables


class TableNotEmpty(RuntimeError):
    """An only-if-empty write met a table that already holds rows."""


class InvalidRows(RuntimeError):
    """A strict insert met rows that do not fit the table."""


# Spark type of each Python annotation in a table dataclass.
PYTHON_TYPES = {
    str: T.StringType(), int: T.LongType(), float: T.DoubleType(), bool: T.BooleanType(),
    bytes: T.BinaryType(), datetime.date: T.DateType(), datetime.datetime: T.TimestampType(),
}


def schema_from_dataclass(cls) -> T.StructType:
    """Declared schema of a dataclass: Optional is nullable, list is repeated, a dataclass is a record.

    A field's `description` metadata becomes the column comment.
    """
    hints = typing.get_type_hints(cls)
    fields = []
    for field in dataclasses.fields(cls):
        kind, nullable = _annotation(hints[field.name])
        meta = {"comment": field.metadata["description"]} if "description" in field.metadata else {}
        fields.append(T.StructField(field.name, kind, nullable, meta))
    return T.StructType(fields)


def _annotation(hint) -> tuple[T.DataType, bool]:
    args = typing.get_args(hint)
    if type(None) in args:
        inner = [a for a in args if a is not type(None)][0]
        return _annotation(inner)[0], True
    if typing.get_origin(hint) is list:
        return T.ArrayType(_annotation(args[0])[0]), True
    if dataclasses.is_dataclass(hint):
        return schema_from_dataclass(hint), False
    return PYTHON_TYPES[hint], False


def all_nullable(kind: T.DataType) -> T.DataType:
    """The same type with every field nullable, as stored tables declare them."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, all_nullable(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(all_nullable(kind.elementType), True)
    return kind


def create_table(spark: SparkSession, name: str, schema: T.StructType, description: str = "",
                 location: str | None = None, expires: int | None = None) -> None:
    """Create a table from a declared schema, keeping comments and the description.

    Its data live in the warehouse and go with the table, unless a location of their own is given.
    `expires` is the epoch second of its expiry, see `set_expiry`.
    """
    if expires is not None:
        _check_epoch(expires)
    spark.catalog.createTable(name, path=location, source="parquet", schema=schema, description=description)
    if expires is not None:
        set_expiry(spark, name, expires)


def _check_epoch(expires: int) -> None:
    if expires < 0:
        raise ValueError("an expiry is an epoch second")


def set_expiry(spark: SparkSession, name: str, expires: int | None) -> None:
    """Let a table expire at an epoch second, or never (None). It stays readable until `drop_expired` meets it."""
    if expires is None:
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{EXPIRES}')")
    else:
        _check_epoch(expires)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{EXPIRES}' = '{int(expires)}')")


def drop_expired(spark: SparkSession, database: str, now: int) -> list[str]:
    """Drop a database's tables whose expiry has come at the epoch second `now`; their names in order."""
    gone = sorted(r["table_name"] for r in expired_tables(spark, database, now).select("table_name").collect())
    for name in gone:
        drop_table(spark, f"{database}.`{name}`")
    return gone


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _by_name(df: DataFrame, name: str) -> DataFrame:
    """df's columns in the order of the table's, which must be the same by name."""
    stored = df.sparkSession.table(name).columns
    if sorted(c.lower() for c in df.columns) != sorted(c.lower() for c in stored):
        raise ValueError(f"columns {df.columns} do not fit table {name} with {stored}")
    return df.select(*[F.col("`" + c.replace("`", "``") + "`") for c in stored])


def query_to_table(df: DataFrame, name: str, disposition: str = "empty", location: str | None = None,
                   dry_run: bool = False) -> None:
    """Write a query result to a table: `truncate`, `append`, or `empty` (the default).

    `empty` accepts a missing table or one without rows and refuses any other.
    Columns are matched by name; `truncate` replaces the schema along with the rows.
    A dry run checks the query and the disposition and writes nothing.
    """
    spark = df.sparkSession
    if disposition not in ("truncate", "append", "empty"):
        raise ValueError(f"unknown write disposition {disposition!r}")
    exists = spark.catalog.tableExists(name)
    if disposition == "empty" and exists and not spark.table(name).isEmpty():
        raise TableNotEmpty(f"table {name} already holds rows")
    if exists and disposition != "truncate":
        df = _by_name(df, name)
    if dry_run:
        return
    if exists and disposition != "truncate":
        df.write.insertInto(name)
        return
    writer = df.write.format("parquet").mode("overwrite" if exists else "errorifexists")
    (writer.option("path", location) if location else writer).saveAsTable(name)


# ---------------------------------------------------------------- validated insert

def validate_lines(lines: DataFrame, line: str, schema: T.StructType, ignore_unknown: bool = False) -> DataFrame:
    """Add `row` (the typed record) and `reason` (null for a valid line) to JSON lines.

    Reasons: malformed JSON, a value of the wrong type, a missing required
    field, or, unless ignored, a key the schema does not declare.
    """
    declared = [f.name for f in schema.fields]
    permissive = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields]
                              + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(line), permissive, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    keys = F.expr(f"json_object_keys(`{line}`)")
    missing = [f.name for f in schema.fields if not f.nullable]
    no_required: Column = F.lit(False)
    for name in missing:
        no_required = no_required | F.col("_parsed")[name].isNull()
    reason = (
        F.when(keys.isNull(), F.lit("malformed"))
        .when(F.col("_parsed")["_corrupt"].isNotNull(), F.lit("wrong type"))
        .when(no_required, F.lit("missing required"))
    )
    if not ignore_unknown:
        unknown = F.array_except(keys, F.array(*[F.lit(c) for c in declared]))
        reason = reason.when(F.size(unknown) > 0, F.lit("unknown field"))
    return (
        lines.withColumn("_parsed", parsed)
        .withColumn("reason", reason)
        .withColumn("row", F.struct(*[F.col("_parsed")[c].alias(c) for c in declared]))
        .drop("_parsed")
    )


def insert_lines(lines: DataFrame, line: str, name: str, schema: T.StructType, skip_invalid: bool = False,
                 ignore_unknown: bool = False) -> DataFrame:
    """Insert JSON lines into a table, created first when missing; returns the refused lines.

    Without `skip_invalid` one bad line refuses the whole batch and nothing is
    written (InvalidRows).
    """
    spark = lines.sparkSession
    if not spark.catalog.tableExists(name):
        create_table(spark, name, all_nullable(schema))
    # validated once, into two parts by outcome: what was checked is what is written
    path = scratch_path(spark, "validated")
    checked = validate_lines(lines, line, schema, ignore_unknown).select(line, "reason", "row")
    checked.withColumn("_refused", F.col("reason").isNotNull()).write.partitionBy("_refused").parquet(path)
    stored = spark.read.schema(T.StructType([
        T.StructField(line, T.StringType()), T.StructField("reason", T.StringType()),
        T.StructField("row", all_nullable(schema)), T.StructField("_refused", T.BooleanType())])).parquet(path)
    refused = stored.where("_refused").select(line, "reason")
    if not skip_invalid and not refused.isEmpty():
        raise InvalidRows(f"batch for {name} refused")
    _by_name(stored.where("NOT _refused").select("row.*"), name).write.insertInto(name)
    return refused
