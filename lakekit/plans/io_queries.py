"""Inputs, sinks, renderers and catalog listings."""

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions import render
from lakekit.functions.aggregates import grouped_string_agg
from lakekit.operators import sinks, tables
from lakekit.plans.registry import query, table
from lakekit.session import cut_lineage, scratch_path
from lakekit.sources import catalog, csv_records, inputs

# Three inputs of three formats as t0..t2, one SQL text with both session functions.
FLAGSHIP = """
SELECT n_name, t1.o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total,
       cpow(count(*), 2) AS n_squared,
       newline_join(sort_array(collect_set(o_orderstatus))) AS statuses
FROM t0 JOIN t1 ON c_custkey = o_custkey JOIN t2 ON c_nationkey = n_nationkey
GROUP BY n_name, t1.o_orderpriority
"""


@query("register_multi_input", """
SELECT n_name, o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total,
       pow(count(*), 2) AS n_squared,
       array_to_string(list_sort(list(DISTINCT o_orderstatus)), chr(10)) AS statuses
FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderpriority
""")
def register_multi_input(spark, sf_dir):
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    csv = sinks.write_result(customer, scratch_path(spark, "customer") + ".csv")
    ndjson = sinks.write_result(orders, scratch_path(spark, "orders") + ".json")
    return inputs.run_query(spark, [csv, ndjson, f"{sf_dir}/nation.parquet"], FLAGSHIP,
                            {0: customer.schema, 1: orders.schema})


@query("scan_ndjson", "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events")
def scan_ndjson(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = sinks.write_result(events, scratch_path(spark, "events") + ".json")
    return inputs.read_input(spark, path).select(
        "event_id", F.col("ts").cast("timestamp_ntz").cast("string").alias("ts"), "user_id", "event_type", "value", "props")


@query("scan_parquet", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty
FROM lineitem WHERE l_shipdate > TIMESTAMP '1997-01-01' GROUP BY l_returnflag, l_linestatus
""")
def scan_parquet(spark, sf_dir):
    return inputs.run_query(spark, [f"{sf_dir}/lineitem.parquet"], """
        SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty
        FROM t0 WHERE l_shipdate > TIMESTAMP_NTZ '1997-01-01' GROUP BY l_returnflag, l_linestatus""")


@query("scan_csv", """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice
FROM part
""")
def scan_csv(spark, sf_dir):
    path = sinks.write_result(table(spark, sf_dir, "part"), scratch_path(spark, "part") + ".csv")
    return inputs.read_input(spark, path).select(
        F.col("p_partkey").cast("long"), "p_name", "p_brand", "p_type", F.col("p_size").cast("long"), "p_retailprice")


def _round_trip(spark, df, extension):
    path = sinks.write_result(df, scratch_path(spark, "result") + extension)
    sinks.write_result(df, path, remove=True)  # a second write replaces, never doubles
    return inputs.read_input(spark, path, df.schema)


# documents with the values that plain text formats tend to lose, chosen by the id
HARD = """CASE doc_id % 8 WHEN 0 THEN '  pad ' WHEN 1 THEN 'a' || chr(10) || 'b' || chr(13) || chr(10) || 'c' WHEN 2 THEN '' WHEN 3 THEN NULL
  WHEN 4 THEN 'say "x", ' || chr(92) || 'n' WHEN 5 THEN '"' WHEN 6 THEN chr(9) || ',' ELSE text END"""
HARD_DOCUMENTS = f"SELECT doc_id, text, {HARD} AS hard, lang, source, n_chars FROM documents"
EVENT_ROWS = "SELECT event_id, CAST(ts AS VARCHAR) AS ts, CAST(ts AS VARCHAR) || '+00' AS at, user_id, event_type, value, props FROM events"


def _hard_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumn("hard", F.expr(HARD))


def _event_round_trip(spark, sf_dir, extension):
    """Events with their time twice: without a zone, and as an instant."""
    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return _round_trip(spark, events, extension).withColumns({
        "ts": F.col("ts").cast("string"), "at": F.concat(F.col("at").cast("string"), F.lit("+00"))})


@query("sink_roundtrip_json", HARD_DOCUMENTS)
def sink_roundtrip_json(spark, sf_dir):
    return _round_trip(spark, _hard_documents(spark, sf_dir), ".json")


@query("sink_roundtrip_json_times", EVENT_ROWS)
def sink_roundtrip_json_times(spark, sf_dir):
    return _event_round_trip(spark, sf_dir, ".json")


@query("sink_roundtrip_csv_text", HARD_DOCUMENTS)
def sink_roundtrip_csv_text(spark, sf_dir):
    return _round_trip(spark, _hard_documents(spark, sf_dir), ".csv")


@query("sink_roundtrip_csv_times", EVENT_ROWS)
def sink_roundtrip_csv_times(spark, sf_dir):
    return _event_round_trip(spark, sf_dir, ".csv")


@query("sink_roundtrip_parquet", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
""")
def sink_roundtrip_parquet(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "orders"), ".parquet").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("sink_roundtrip_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer")
def sink_roundtrip_csv(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return _round_trip(spark, df, ".csv")


# ---------------------------------------------------------------- metadata with the data behind it

LINEITEM_COLUMNS = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"))
CUSTOMER_COLUMNS = (
    ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
    ("c_mktsegment", "string"))


@query("describe_table", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, 'YES' AS is_nullable, count({c}) AS n_values FROM lineitem"
    for c, t in LINEITEM_COLUMNS))
def describe_table(spark, sf_dir):
    """Described columns of t0, each with the values the scan finds in it."""
    inputs.register_inputs(spark, [f"{sf_dir}/lineitem.parquet"])
    return inputs.describe_table(spark, "t0").join(
        F.broadcast(inputs.column_fill(spark.table("t0")).drop("table_name")), "column_name")


@query("information_schema_columns", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({i} AS BIGINT) AS ordinal, '{k}' AS data_type, "
    f"'YES' AS is_nullable, count({c}) AS n_values FROM {src}"
    for t, src, cols in (("t0", "lineitem", LINEITEM_COLUMNS), ("t1", "customer", CUSTOMER_COLUMNS))
    for i, (c, k) in enumerate(cols, 1)))
def information_schema_columns(spark, sf_dir):
    names = inputs.register_inputs(spark, [f"{sf_dir}/lineitem.parquet", f"{sf_dir}/customer.parquet"])
    fill = inputs.column_fill(spark.table("t0"), "t0").union(inputs.column_fill(spark.table("t1"), "t1"))
    return inputs.information_schema_columns(spark, names).join(F.broadcast(fill), ["table_name", "column_name"])


@query("query_dry_run_schema", """
WITH r AS (SELECT o_custkey AS custkey, count(*) AS n, max(o_totalprice) AS top,
                  max(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS prio FROM orders GROUP BY o_custkey)
SELECT 'custkey' AS column_name, 'bigint' AS data_type, count(custkey) AS n_values FROM r
UNION ALL SELECT 'n', 'bigint', count(n) FROM r UNION ALL SELECT 'top', 'double', count(top) FROM r
UNION ALL SELECT 'prio', 'string', count(prio) FROM r
""")
def query_dry_run_schema(spark, sf_dir):
    """The schema a dry run promises, checked against what the run then fills in."""
    text = """SELECT o_custkey AS custkey, count(*) AS n, max(o_totalprice) AS top,
                     max(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS prio
              FROM {orders} GROUP BY o_custkey"""
    orders = table(spark, sf_dir, "orders")
    schema = inputs.dry_run(spark, text, orders=orders)
    promised = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields],
                                     "column_name STRING, data_type STRING")
    fill = inputs.column_fill(spark.sql(text, orders=orders)).drop("table_name")
    return promised.join(F.broadcast(fill), "column_name")


@query("query_limited", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25
""")
def query_limited(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return inputs.limited(orders, 25, "o_orderkey")


@query("catalog_listing", """
SELECT 'orders' AS table_name, 'MANAGED' AS table_type, true AS has_created, count(*) AS n_rows FROM orders
UNION ALL SELECT 'customer', 'MANAGED', true, count(*) FROM customer
""")
def catalog_listing(spark, sf_dir):
    """Two tables stored in a database of their own, listed with creation time and row count."""
    database = "lk_" + scratch_path(spark, "x").rsplit("-", 1)[1][:12]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    counts = None
    for name in ("orders", "customer"):
        tables.query_to_table(table(spark, sf_dir, name), f"{database}.{name}")
        one = spark.table(f"{database}.{name}").agg(F.count("*").alias("n_rows")).withColumn("table_name", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    listed = catalog.list_tables(spark, database).select(
        "table_name", "table_type", F.col("created_epoch").isNotNull().alias("has_created"))
    out = cut_lineage(listed.join(F.broadcast(counts), "table_name"))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


@query("table_expiry", """
WITH t AS (SELECT lower(c_mktsegment) AS table_name, sum(c_custkey)::BIGINT AS expires_epoch, count(*) AS n_rows FROM customer GROUP BY 1)
SELECT * FROM t WHERE expires_epoch > (SELECT median(expires_epoch) FROM t)
UNION ALL SELECT 'all_customers', NULL, count(*) FROM customer
""")
def table_expiry(spark, sf_dir):
    """One table a market segment, expiring at the sum of its keys, and one without expiry: what is listed once those up to the median are dropped."""
    database = "lk_" + scratch_path(spark, "x").rsplit("-", 1)[1][:12]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    customer = table(spark, sf_dir, "customer")
    segments = customer.groupBy("c_mktsegment").agg(F.sum("c_custkey").alias("expires"), F.count("*").alias("n_rows"))
    segments = cut_lineage(segments.withColumn("table_name", F.lower("c_mktsegment")))
    tables.query_to_table(customer, f"{database}.all_customers")
    for row in segments.collect():  # five market segments at any size
        name = f"{database}.`{row['table_name']}`"
        tables.query_to_table(customer.where(F.col("c_mktsegment") == row["c_mktsegment"]), name)
        tables.set_expiry(spark, name, row["expires"])
    tables.drop_expired(spark, database, int(segments.agg(F.median("expires")).first()[0]))
    listed = catalog.list_tables(spark, database).select("table_name", "expires_epoch")
    stored = [spark.table(f"{database}.`{r['table_name']}`").agg(F.count("*").alias("n_rows")).withColumn("table_name", F.lit(r["table_name"]))
              for r in listed.select("table_name").collect()]
    out = cut_lineage(listed.join(F.broadcast(reduce(DataFrame.unionByName, stored)), "table_name"))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


@query("catalog_databases", """
SELECT 'spark_catalog' AS catalog, 'own' AS database, count(*) AS n_rows FROM nation
""")
def catalog_databases(spark, sf_dir):
    """The catalog and the database a stored table stands in, found through both listings."""
    database = "lk_" + scratch_path(spark, "x").rsplit("-", 1)[1][:12]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    tables.query_to_table(table(spark, sf_dir, "nation"), f"{database}.nation")
    n_rows = spark.table(f"{database}.nation").agg(F.count("*").alias("n_rows"))
    found = catalog.list_catalogs(spark).join(catalog.list_databases(spark).where(F.col("database") == database), "catalog")
    out = cut_lineage(found.withColumn("database", F.lit("own")).join(F.broadcast(n_rows)))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


# ---------------------------------------------------------------- statements through the SQL front door

def _statements(spark, sf_dir, name, texts):
    """Run SQL statements in turn over the named table as t0; the last one's rows, kept in scratch."""
    path = f"{sf_dir}/{name}.parquet"
    out = None
    for text in texts:
        out = inputs.run_query(spark, [path], text)
    return cut_lineage(out)


@query("sql_create_view", "SELECT o_orderstatus, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def sql_create_view(spark, sf_dir):
    return _statements(spark, sf_dir, "orders", [
        "CREATE OR REPLACE TEMPORARY VIEW lk_dear AS SELECT * FROM t0 WHERE o_totalprice > 1000",
        "SELECT o_orderstatus, count(*) AS n, sum(o_custkey) AS keys FROM lk_dear GROUP BY 1"])


@query("sql_ctas_insert_show", """
SELECT n_regionkey, 2 * count(*) AS n, 1 AS n_tables FROM nation WHERE n_regionkey < 3 GROUP BY 1
UNION ALL SELECT n_regionkey, count(*), 1 FROM nation WHERE n_regionkey >= 3 GROUP BY 1
""")
def sql_ctas_insert_show(spark, sf_dir):
    """CREATE TABLE AS, INSERT with named columns, SHOW TABLES and DROP as statements."""
    name = "lk_" + scratch_path(spark, "x").rsplit("-", 1)[1][:12]
    out = _statements(spark, sf_dir, "nation", [
        f"CREATE TABLE {name} USING parquet AS SELECT n_nationkey, n_regionkey FROM t0",
        f"INSERT INTO {name} (n_regionkey, n_nationkey) SELECT n_regionkey, n_nationkey FROM t0 WHERE n_regionkey < 3",
        f"SELECT n_regionkey, count(*) AS n FROM {name} GROUP BY 1"])
    shown = inputs.run_query(spark, [], f"SHOW TABLES LIKE '{name}'").where("NOT isTemporary").agg(F.count("*").cast("int").alias("n_tables"))
    out = cut_lineage(out.join(F.broadcast(shown)))
    inputs.run_query(spark, [], f"DROP TABLE {name}")
    return out


@query("sql_session_functions", """
SELECT event_type, strftime(time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS bin,
       count(*) AS n, sum(user_id // 7)::BIGINT AS sevenths FROM events GROUP BY 1, 2
""")
def sql_session_functions(spark, sf_dir):
    return inputs.run_query(spark, [f"{sf_dir}/events.parquet"], """
        SELECT event_type, date_format(date_bin(INTERVAL 15 MINUTE, cast(ts AS TIMESTAMP)), 'yyyy-MM-dd HH:mm:ss') AS bin,
               count(*) AS n, sum(int_div(user_id, 7)) AS sevenths FROM t0 GROUP BY 1, 2""")


@query("schema_flatten", """
SELECT 'l_orderkey' AS path, 'bigint' AS type, 'NULLABLE' AS mode, count(l_orderkey) AS n_values FROM lineitem
UNION ALL SELECT 'price', 'RECORD', 'NULLABLE', count(*) FROM lineitem
UNION ALL SELECT 'price.base', 'double', 'NULLABLE', count(l_extendedprice) FROM lineitem
UNION ALL SELECT 'price.discount', 'double', 'NULLABLE', count(nullif(l_discount, 0)) FROM lineitem
UNION ALL SELECT 'flags', 'RECORD', 'REPEATED', 2 * count(*) FROM lineitem
UNION ALL SELECT 'flags.name', 'string', 'NULLABLE', 2 * count(*) FROM lineitem
UNION ALL SELECT 'flags.value', 'string', 'NULLABLE', count(l_returnflag) + count(nullif(l_linestatus, 'F')) FROM lineitem
UNION ALL SELECT 'sizes', 'double', 'REPEATED', count(l_quantity) + count(nullif(l_tax, 0)) FROM lineitem
""")
def schema_flatten(spark, sf_dir):
    """Flattened schema of nested rows, each path with the values held there."""
    nested = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.struct(F.col("l_extendedprice").alias("base"),
                 F.nullif("l_discount", F.lit(0.0)).alias("discount")).alias("price"),
        F.array(F.struct(F.nullif(F.lit("return"), F.lit("")).alias("name"), F.col("l_returnflag").alias("value")),
                F.struct(F.nullif(F.lit("status"), F.lit("")).alias("name"),
                         F.nullif("l_linestatus", F.lit("F")).alias("value"))).alias("flags"),
        F.array(F.col("l_quantity"), F.nullif("l_tax", F.lit(0.0))).alias("sizes"))
    schema = tables.all_nullable(nested.schema)
    return (catalog.schema_rows(spark, schema).drop("description")
            .join(F.broadcast(catalog.leaf_fill(nested)), "path"))


@query("read_table", """
SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events
""")
def read_table(spark, sf_dir):
    name = "lk_" + scratch_path(spark, "x").rsplit("-", 1)[1][:12]
    tables.query_to_table(table(spark, sf_dir, "events"), name)
    out = cut_lineage(catalog.read_table(spark, name).withColumn("ts", F.col("ts").cast("string")))
    tables.drop_table(spark, name)
    return out


# ---------------------------------------------------------------- renderers

RENDERED = "SELECT c_custkey AS k, c_name AS n, c_acctbal AS b, nullif(c_mktsegment, 'BUILDING') AS s FROM customer"


def _rendered(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), F.col("c_acctbal").alias("b"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("s"))


@query("rows_to_json", f"""
SELECT '{{"k":' || k || ',"n":"' || n || '","b":' || b || ',"s":' || coalesce('"' || s || '"', 'null') || '}}' AS json
FROM ({RENDERED})
""")
def rows_to_json(spark, sf_dir):
    return render.rows_to_json(_rendered(spark, sf_dir))


@query("rows_to_json_cells", f"""
SELECT CAST(k AS VARCHAR) AS k, '"' || n || '"' AS n, CAST(b AS VARCHAR) AS b, coalesce('"' || s || '"', 'null') AS s
FROM ({RENDERED})
""")
def rows_to_json_cells(spark, sf_dir):
    return render.rows_to_json_cells(_rendered(spark, sf_dir))


@query("rows_to_text", f"""
SELECT '{{"k": ' || k || ',"n": "' || n || '","b": ' || regexp_replace(CAST(b AS VARCHAR), '\\.0$', '') ||
       coalesce(',"s": "' || s || '"', '') || ',"l": ["' || n || '",' || coalesce('"' || s || '"', 'null') || ']}}' AS row_text
FROM ({RENDERED})
""")
def rows_to_text(spark, sf_dir):
    return render.rows_to_text(_rendered(spark, sf_dir).withColumn("l", F.array("n", "s")))


# times with no, three and six digits of a second, and numbers from 1e-290 to 1e300
TIMED = """SELECT event_id AS k, date_trunc('second', ts) + to_microseconds(CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 250000 ELSE 123456 END) AS t
FROM events"""
DIGITS = "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '.250' ELSE '.123456' END"


def _timed(spark, sf_dir):
    fraction = F.expr("CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 250000 ELSE 123456 END")
    at = F.timestamp_micros(F.unix_micros(F.date_trunc("second", F.col("ts").cast("timestamp"))) + fraction)
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("k"), at.alias("t"), at.cast("timestamp_ntz").alias("l"))


@query("rows_to_json_times", f"""
SELECT '{{"k":' || event_id || ',"t":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || {DIGITS} || '+00:00","l":"' ||
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || rpad(ltrim({DIGITS}, '.'), 6, '0') || '"}}' AS json FROM events
""")
def rows_to_json_times(spark, sf_dir):
    return render.rows_to_json(_timed(spark, sf_dir))


@query("rows_to_json_cells_times", f"""
SELECT CAST(event_id AS VARCHAR) AS k, '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || {DIGITS} || '+00:00"' AS t,
       '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || rpad(ltrim({DIGITS}, '.'), 6, '0') || '"' AS l FROM events
""")
def rows_to_json_cells_times(spark, sf_dir):
    return render.rows_to_json_cells(_timed(spark, sf_dir))


@query("rows_to_text_times", f"""
SELECT '{{"k": ' || event_id || ',"t": "' || strftime(ts, '%Y-%m-%d %H:%M:%S') || {DIGITS} || ' UTC","l": "' ||
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || rpad(ltrim({DIGITS}, '.'), 6, '0') || '"}}' AS row_text FROM events
""")
def rows_to_text_times(spark, sf_dir):
    return render.rows_to_text(_timed(spark, sf_dir))


@query("rows_to_text_numbers", """
WITH c AS (SELECT CAST(c_custkey + 1 AS VARCHAR) AS k FROM customer)
SELECT '{"tiny": ' || '0.' || repeat('0', 290 - length(k)) || rtrim(k, '0') ||
       ',"huge": -' || k || repeat('0', 300) || ',"mid": ' || k || '.5}' AS row_text FROM c
""")
def rows_to_text_numbers(spark, sf_dir):
    key = (F.col("c_custkey") + 1).cast("string")
    return render.rows_to_text(table(spark, sf_dir, "customer").select(
        F.concat(key, F.lit("e-290")).cast("double").alias("tiny"), F.concat(F.lit("-"), key, F.lit("e300")).cast("double").alias("huge"),
        F.concat(key, F.lit(".5")).cast("double").alias("mid")))


@query("string_agg_newline", """
SELECT l_orderkey, list_reduce(list(x ORDER BY l_linenumber, l_partkey, x), lambda a, v:
         CASE WHEN length(a) > 0 THEN a || chr(10) || v ELSE v END, '') AS lines
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
             CASE WHEN l_returnflag = 'N' THEN '' ELSE concat(l_returnflag, l_suppkey) END AS x FROM lineitem)
GROUP BY l_orderkey
""")
def string_agg_newline(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.concat("l_returnflag", "l_suppkey")).alias("x"))
    return grouped_string_agg(lines, ["l_orderkey"], "x", ["l_linenumber", "l_partkey"], "lines")


@query("string_agg_large_groups", """
SELECT l_returnflag, count(*) AS n, length(string_agg(x, chr(10) ORDER BY l_orderkey, l_linenumber, l_partkey, x)) AS n_chars,
       md5(string_agg(x, chr(10) ORDER BY l_orderkey, l_linenumber, l_partkey, x)) AS joined
FROM (SELECT *, concat(l_returnflag, l_suppkey) AS x FROM lineitem) GROUP BY l_returnflag
""")
def string_agg_large_groups(spark, sf_dir):
    """Three groups that hold the whole table."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", F.concat("l_returnflag", "l_suppkey").alias("x"))
    joined = grouped_string_agg(lines, ["l_returnflag"], "x", ["l_orderkey", "l_linenumber", "l_partkey"], "text")
    sizes = lines.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    return joined.join(sizes, "l_returnflag").select(
        "l_returnflag", "n", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("joined"))


NEWLINE_LINES = """(SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linestatus = 'F' THEN '' ELSE concat(l_returnflag, l_suppkey) END AS x FROM {t})"""
NEWLINE_ORACLE = """
SELECT {key}, count(*) AS n, {text} AS lines FROM (
  SELECT {key}, x, bool_or(x <> '') OVER (PARTITION BY {key} ORDER BY l_orderkey, l_linenumber, l_partkey, x) AS begun,
         row_number() OVER (PARTITION BY {key} ORDER BY l_orderkey, l_linenumber, l_partkey, x) AS nr FROM {lines}) GROUP BY {key}
"""
NEWLINE_JOINED = "coalesce(array_to_string(list(x ORDER BY nr) FILTER (WHERE begun), chr(10)), '')"


def _newline_agg(spark, sf_dir, key, result):
    return inputs.run_query(spark, [f"{sf_dir}/lineitem.parquet"], f"""
        SELECT {key}, count(*) AS n, {result.format("newline_text(listagg(newline_item(x), '\n') WITHIN GROUP (ORDER BY l_orderkey, l_linenumber, l_partkey, x))")} AS lines
        FROM {NEWLINE_LINES.format(t='t0')} GROUP BY {key}""")


@query("sql_newline_agg", NEWLINE_ORACLE.format(key="l_orderkey", text=NEWLINE_JOINED, lines=NEWLINE_LINES.format(t="lineitem")))
def sql_newline_agg(spark, sf_dir):
    """The newline aggregate in SQL, over many small groups."""
    return _newline_agg(spark, sf_dir, "l_orderkey", "{}")


PIECE = 250_000  # rows joined at once, as a list in memory


@query("sql_newline_agg_large", NEWLINE_ORACLE.format(key="l_returnflag", text=f"md5({NEWLINE_JOINED})", lines=NEWLINE_LINES.format(t="lineitem")))
def sql_newline_agg_large(spark, sf_dir):
    """The same over three groups that hold the whole table: ranges in order are joined first, each by a task, and a group's last step reads their texts only."""
    order = "l_orderkey, l_linenumber, l_partkey, x"
    pieces = 1 + table(spark, sf_dir, "lineitem").count() // PIECE
    return inputs.run_query(spark, [f"{sf_dir}/lineitem.parquet"], f"""
        SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS n, md5(newline_text(listagg(piece, '\n') WITHIN GROUP (ORDER BY part))) AS lines
        FROM (SELECT l_returnflag, part, count(*) AS n, listagg(newline_item(x), '\n') WITHIN GROUP (ORDER BY {order}) AS piece
              FROM (SELECT *, spark_partition_id() AS part FROM (
                      SELECT /*+ REPARTITION_BY_RANGE({pieces}, l_returnflag, {order}) */ * FROM {NEWLINE_LINES.format(t='t0')}))
              GROUP BY l_returnflag, part)
        GROUP BY l_returnflag""")


@query("csv_one_column", "SELECT CASE WHEN doc_id % 3 > 0 THEN CASE WHEN doc_id % 5 > 0 THEN text ELSE '' END END AS line FROM documents")
def csv_one_column(spark, sf_dir):
    """Nulls, empty texts and line breaks in a file of one column."""
    line = F.expr("CASE WHEN doc_id % 3 > 0 THEN CASE WHEN doc_id % 5 > 0 THEN text ELSE '' END END")
    path = sinks.write_result(table(spark, sf_dir, "documents").select(line.alias("line")), scratch_path(spark, "one") + ".csv")
    return inputs.read_input(spark, path, "line STRING")


@query("csv_crlf", "SELECT doc_id, replace(text, ' ', chr(13) || chr(10)) AS text, lang FROM documents")
def csv_crlf(spark, sf_dir):
    """Records that end with CRLF and hold line breaks of both kinds."""
    quoted = F.concat(F.lit('"'), F.replace(F.replace("text", F.lit(" "), F.lit("\r\n")), F.lit('"'), F.lit('""')), F.lit('"'))
    lines = table(spark, sf_dir, "documents").select(F.concat_ws(",", F.col("doc_id").cast("string"), quoted, "lang").alias("line"))
    path = scratch_path(spark, "crlf") + ".csv"
    lines.hint("rebalance").sortWithinPartitions("line").mapInArrow(_with_header("doc_id,text,lang"), "line STRING").write.option("lineSep", "\r\n").text(path)
    return inputs.read_input(spark, path, "doc_id BIGINT, text STRING, lang STRING")


def _with_header(header):
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], names=["line"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["line"])

    return run


@query("csv_cut_file", "SELECT doc_id, text || chr(10) || '\"' AS text, source FROM documents")
def csv_cut_file(spark, sf_dir):
    """One file whose values hold line breaks and quotes, read in ranges of 64 KB."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit('\n"')).alias("text"), "source")
    path = sinks.write_result(rows, scratch_path(spark, "cut") + ".csv")
    return csv_records.read_csv(spark, path, "doc_id BIGINT, text STRING, source STRING", 1 << 16)
