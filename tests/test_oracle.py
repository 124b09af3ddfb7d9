"""Every registered query against its SQL counterpart on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import TABLES, rows_of  # noqa: E402

from lakekit.plans import catalog  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query(spark, duck, key):
    df = catalog.queries()[key](spark, SF_DIR)
    rows = df.collect()
    sql = catalog.oracle_sql().get(key)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, rows) == rows_of(names, cursor.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
