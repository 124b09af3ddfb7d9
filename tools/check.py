"""Run registered queries and compare them with their SQL counterparts in DuckDB.

usage: python tools/check.py SF_DIR [key-substring ...]
"""

from __future__ import annotations

import decimal
import logging
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakekit.plans import catalog  # noqa: E402
from lakekit.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# the driver-side error log repeats whole JVM traces
logging.disable(logging.ERROR)


def canon(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canon(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{canon(v)}" for k, v in sorted(value.items())) + "}"
    if hasattr(value, "asDict"):
        return canon(value.asDict())
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in rows)


def main(sf_dir, wanted):
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    queries, oracles = catalog.queries(), catalog.oracle_sql()
    keys = [k for k in queries if not wanted or any(w in k for w in wanted)]
    bad = []
    for key in keys:
        start = time.time()
        try:
            df = queries[key](spark, sf_dir)
            got = df.collect()
        except Exception as error:  # report and go on
            bad.append(key)
            print(f"FAIL {key}: spark {type(error).__name__}: {str(error)[:900]}", flush=True)
            continue
        took = time.time() - start
        if key not in oracles:
            print(f"rows {key}: {len(got)} rows {took:.1f}s", flush=True)
            continue
        try:
            start = time.time()
            cursor = duck.execute(oracles[key])
            names = [d[0] for d in cursor.description]
            types = [str(d[1]) for d in cursor.description]
            want = cursor.fetchall()
            duck_took = time.time() - start
        except Exception as error:
            bad.append(key)
            print(f"FAIL {key}: oracle {str(error)[:600]}", flush=True)
            continue
        a, b = rows_of(df.columns, got), rows_of(names, want)
        if sorted(df.columns) != sorted(names) or a != b:
            bad.append(key)
            print(f"DIFF {key}: {len(a)} vs {len(b)} rows; {sorted(df.columns)} vs {sorted(names)}")
            only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
            print("   spark :", *[r[:300] for r in only_a], sep="\n     ")
            print("   oracle:", *[r[:300] for r in only_b], sep="\n     ", flush=True)
        else:
            pair = dict(zip(names, types))
            mism = [f"{f.name}:{f.dataType.simpleString()}/{pair[f.name]}" for f in df.schema
                    if not same_type(f.dataType.simpleString(), pair[f.name])]
            print(f"ok   {key}: {len(a)} rows {took:.1f}s (duckdb {duck_took:.2f}s)"
                  + (f"  TYPES {mism}" if mism else "") + ("  EMPTY" if not a else ""), flush=True)
    print(f"{len(keys) - len(bad)}/{len(keys)} fine; bad: {bad}")
    spark.stop()
    return 1 if bad else 0


def same_type(spark_type, duck_type):
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    return pairs.get(spark_type, spark_type).upper() == duck_type.upper() or (
        spark_type.startswith("array") and duck_type.endswith("[]"))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
