"""Registry of runnable queries with their ANSI SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakekit.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _add(key: str, run: Query, oracle: str | None) -> None:
    if key in QUERIES:
        raise ValueError(f"duplicate query key {key}")

    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    QUERIES[key] = configured
    if oracle is not None:
        ORACLES[key] = oracle


def query(key: str, oracle: str | None = None):
    """Register a DataFrame-building function under `key`."""

    def wrap(run: Query) -> Query:
        _add(key, run, oracle)
        return run

    return wrap


def sql_query(key: str, tables: str, text: str, oracle: str | None = None, check: bool = True) -> None:
    """Register SQL text over `{table}` markers; the oracle defaults to the same text."""
    names = tables.split()

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})

    if check:
        plain = oracle if oracle is not None else text
        for name in names:
            plain = plain.replace("{" + name + "}", name)
        _add(key, run, plain)
    else:
        _add(key, run, None)
