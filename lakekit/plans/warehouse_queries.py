"""Typed tables, validated insert, schema mapping and wire-row decoding."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.operators import tables, wire
from lakekit.operators.wire import WireField
from lakekit.plans.registry import query, table
from lakekit.session import cut_lineage, scratch_path
from lakekit.sources import catalog, inputs


def _name(spark):
    return "lk_" + scratch_path(spark, "x").rsplit("-", 1)[1][:16]


def _stored(spark, name):
    """The stored rows, kept in scratch; the table goes with its data."""
    out = cut_lineage(spark.table(name))
    tables.drop_table(spark, name)
    return out


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")


@query("query_to_table_truncate", """
SELECT c_custkey, c_name, c_acctbal, count(*) AS copies FROM customer GROUP BY ALL
""")
def query_to_table_truncate(spark, sf_dir):
    name, rows = _name(spark), _customers(spark, sf_dir)
    tables.query_to_table(rows.withColumn("c_name", F.lit("old")), name, "truncate")
    tables.query_to_table(rows, name, "truncate")
    return _stored(spark, name).groupBy("c_custkey", "c_name", "c_acctbal").agg(F.count("*").alias("copies"))


@query("query_to_table_append", """
SELECT c_custkey, c_name, c_acctbal, 2 * count(*) AS copies FROM customer GROUP BY ALL
""")
def query_to_table_append(spark, sf_dir):
    name, rows = _name(spark), _customers(spark, sf_dir)
    tables.query_to_table(rows, name, "append")
    tables.query_to_table(rows, name, "append")
    return _stored(spark, name).groupBy("c_custkey", "c_name", "c_acctbal").agg(F.count("*").alias("copies"))


@query("query_to_table_empty", """
SELECT c_custkey, c_name, c_acctbal, count(*) AS copies, true AS second_refused FROM customer GROUP BY ALL
""")
def query_to_table_empty(spark, sf_dir):
    name, rows = _name(spark), _customers(spark, sf_dir)
    tables.create_table(spark, name, rows.schema)       # present but empty: allowed
    tables.query_to_table(rows, name, "empty")
    try:
        tables.query_to_table(rows, name, "empty")
        refused = False
    except tables.TableNotEmpty:
        refused = True
    return (_stored(spark, name).groupBy("c_custkey", "c_name", "c_acctbal").agg(F.count("*").alias("copies"))
            .withColumn("second_refused", F.lit(refused)))


@query("query_to_table_by_name", """
SELECT c_custkey, c_name, c_acctbal, CAST(1 + (c_nationkey < 10)::INT AS BIGINT) AS copies FROM customer
""")
def query_to_table_by_name(spark, sf_dir):
    """An append whose columns stand in another order lands by name."""
    name, rows = _name(spark), table(spark, sf_dir, "customer")
    tables.query_to_table(rows.select("c_custkey", "c_name", "c_acctbal"), name)
    tables.query_to_table(rows.where("c_nationkey < 10").select("c_acctbal", "c_custkey", "c_name"), name, "append")
    return _stored(spark, name).groupBy("c_custkey", "c_name", "c_acctbal").agg(F.count("*").alias("copies"))


@query("query_to_table_new_schema", """
SELECT CAST(c_custkey AS VARCHAR) AS label, c_acctbal > 0 AS positive, 'label,positive' AS columns_now FROM customer
""")
def query_to_table_new_schema(spark, sf_dir):
    """A truncating write replaces the columns along with the rows."""
    name, rows = _name(spark), table(spark, sf_dir, "customer")
    tables.query_to_table(rows.select("c_custkey", "c_name"), name)
    tables.query_to_table(rows.select(F.col("c_custkey").cast("string").alias("label"), (F.col("c_acctbal") > 0).alias("positive")),
                          name, "truncate")
    out = _stored(spark, name)
    return out.withColumn("columns_now", F.lit(",".join(out.columns)))


@query("drop_table_removes_data", """
SELECT count(*) AS n_rows, count(*) > 0 AS files_before, false AS files_after FROM customer
""")
def drop_table_removes_data(spark, sf_dir):
    """The files under a managed table's location before and after the drop."""
    name = _name(spark)
    tables.query_to_table(table(spark, sf_dir, "customer"), name)
    n_rows = spark.table(name).count()
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    before = files.exists(path)
    tables.drop_table(spark, name)
    return spark.createDataFrame([(n_rows, bool(before), bool(files.exists(path)))],
                                 "n_rows BIGINT, files_before BOOLEAN, files_after BOOLEAN")


PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType(), True, {"comment": "part number"}),
    T.StructField("p_name", T.StringType(), True, {"comment": "display name"}),
    T.StructField("p_small", T.IntegerType(), True, {"comment": "size up to 25"}),
])


@query("create_table_schema", """
SELECT 'p_partkey' AS path, 'bigint' AS type, 'part number' AS description, count(p_partkey) AS n_values FROM part
UNION ALL SELECT 'p_name', 'string', 'display name', count(p_name) FROM part
UNION ALL SELECT 'p_small', 'int', 'size up to 25', count(CASE WHEN p_size <= 25 THEN 1 END) FROM part
""")
def create_table_schema(spark, sf_dir):
    """Declared columns and comments as the catalog keeps them, with the rows then inserted."""
    name = _name(spark)
    tables.create_table(spark, name, PART_SCHEMA, "parts by declared schema")
    table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") <= 25, F.col("p_size"))).write.insertInto(name)
    stored = _stored(spark, name)
    fill = inputs.column_fill(stored).select(F.col("column_name").alias("path"), "n_values")
    return catalog.schema_rows(spark, stored.schema).drop("mode").join(F.broadcast(fill), "path")


# ---------------------------------------------------------------- validated insert
# Lines come from customer; their own attributes decide which ones are faulty.

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType()),
    T.StructField("score", T.DoubleType())])


def _customer_lines(spark, sf_dir):
    key, name, score = F.col("c_custkey"), F.col("c_name"), F.col("c_acctbal")
    good = F.to_json(F.struct(key.alias("id"), name.alias("name"), score.alias("score")))
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") == 3, F.concat(F.lit('{"id": '), key, F.lit(", ")))
        .when(F.col("c_mktsegment") == "MACHINERY",
              F.to_json(F.struct(key.alias("id"), name.alias("name"), F.lit("n/a").alias("score"))))
        .when(score < 0, F.to_json(F.struct(name.alias("name"), score.alias("score"))))
        .when(F.col("c_mktsegment") == "HOUSEHOLD",
              F.to_json(F.struct(key.alias("id"), name.alias("name"), score.alias("score"),
                                 F.col("c_mktsegment").alias("segment"))))
        .otherwise(good).alias("line"))


FAULT = """CASE WHEN c_nationkey = 3 THEN 'malformed' WHEN c_mktsegment = 'MACHINERY' THEN 'wrong type'
                WHEN c_acctbal < 0 THEN 'missing required'
                WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown field' END"""


@query("insert_validated", f"""
SELECT coalesce({FAULT}, 'valid') AS outcome, count(*) AS n_lines, CAST(0 AS BIGINT) AS n_inserted, true AS refused
FROM customer GROUP BY 1
""")
def insert_validated(spark, sf_dir):
    """A strict insert: faulty lines refuse the whole batch, reported by reason."""
    name, lines = _name(spark), _customer_lines(spark, sf_dir)
    try:
        tables.insert_lines(lines, "line", name, CUSTOMER_SCHEMA)
        refused = False
    except tables.InvalidRows:
        refused = True
    inserted = _stored(spark, name).count()
    checked = tables.validate_lines(lines, "line", CUSTOMER_SCHEMA)
    return (checked.groupBy(F.coalesce("reason", F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n_lines"))
            .withColumns({"n_inserted": F.lit(inserted).cast("long"), "refused": F.lit(refused)}))


@query("insert_skip_invalid", f"""
SELECT c_custkey AS id, c_name AS name, c_acctbal AS score FROM customer WHERE {FAULT} IS NULL
""")
def insert_skip_invalid(spark, sf_dir):
    name = _name(spark)
    tables.insert_lines(_customer_lines(spark, sf_dir), "line", name, CUSTOMER_SCHEMA, skip_invalid=True)
    return _stored(spark, name)


@query("insert_ignore_unknown", f"""
SELECT c_custkey AS id, c_name AS name, c_acctbal AS score FROM customer
WHERE coalesce({FAULT}, 'unknown field') = 'unknown field'
""")
def insert_ignore_unknown(spark, sf_dir):
    name = _name(spark)
    tables.insert_lines(_customer_lines(spark, sf_dir), "line", name, CUSTOMER_SCHEMA, skip_invalid=True,
                        ignore_unknown=True)
    return _stored(spark, name)


# ---------------------------------------------------------------- schema mapping

TYPE_NAMES = ("STRING", "FLOAT", "INTEGER", "NUMERIC", "BOOLEAN", "TIMESTAMP", "DATE", "DATETIME", "TIME",
              "RECORD", "JSON", "GEOGRAPHY")
MODE_NAMES = ("REQUIRED", "NULLABLE", "REPEATED", "OTHER")


@query("schema_map_types", f"""
WITH c AS (SELECT p_partkey, ['{"','".join(TYPE_NAMES)}'][1 + p_size % {len(TYPE_NAMES)}] AS type,
                  nullif(['{"','".join(MODE_NAMES)}'][1 + p_partkey % {len(MODE_NAMES)}], 'OTHER') AS mode FROM part)
SELECT p_partkey, type, mode,
       CASE type WHEN 'NUMERIC' THEN 'FLOAT' WHEN 'GEOGRAPHY' THEN 'UNKNOWN' ELSE type END AS read_type,
       CASE type WHEN 'FLOAT' THEN 'NUMERIC' WHEN 'GEOGRAPHY' THEN NULL ELSE type END AS write_type,
       coalesce(mode, 'UNKNOWN') AS read_mode
FROM c
""")
def schema_map_types(spark, sf_dir):
    """Type and mode mapping over one column declaration per part."""
    declared = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.get(F.array(*map(F.lit, TYPE_NAMES)), F.col("p_size") % len(TYPE_NAMES)).alias("type"),
        F.nullif(F.get(F.array(*map(F.lit, MODE_NAMES)), (F.col("p_partkey") % len(MODE_NAMES)).cast("int")),
                 F.lit("OTHER")).alias("mode"))
    return wire.map_declared_columns(declared)


# ---------------------------------------------------------------- wire rows

EVENT_FIELDS = [
    WireField("event_id", "INTEGER", "REQUIRED"), WireField("ts", "TIMESTAMP"), WireField("user_id", "INTEGER"),
    WireField("event_type", "STRING"), WireField("value", "FLOAT"), WireField("props", "JSON"),
    WireField("is_error", "BOOLEAN"), WireField("day", "DATE"), WireField("at", "DATETIME"), WireField("tod", "TIME"),
]


@query("decode_rows_flat", """
SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS ts, user_id, event_type, value, props,
       event_type = 'error' AS is_error, strftime(ts, '%Y-%m-%d') AS day,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, strftime(ts, '%H:%M:%S') AS tod, false AS _decode_error
FROM events
""")
def decode_rows_flat(spark, sf_dir):
    """Events in wire form and back; timestamps keep whole seconds only."""
    ts = F.col("ts")
    lines = table(spark, sf_dir, "events").select(wire.encode_row(
        F.col("event_id"), F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)"),
        F.col("user_id"), F.col("event_type"), F.col("value"), F.col("props"), F.col("event_type") == "error",
        F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.date_format(ts, "HH:mm:ss.SSSSSS")).alias("line"))
    return (wire.decode_rows(lines, "line", EVENT_FIELDS, json_text=True)
            .withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).withColumn("day", F.date_format("day", "yyyy-MM-dd"))
            .withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


LINE_FIELDS = [
    WireField("orderkey", "INTEGER", "REQUIRED"),
    WireField("amounts", "FLOAT", "REPEATED"),
    WireField("part", "RECORD", "NULLABLE", (WireField("key", "INTEGER"), WireField("flag", "STRING"))),
    WireField("steps", "RECORD", "REPEATED", (
        WireField("name", "STRING"), WireField("codes", "INTEGER", "REPEATED"),
        WireField("at", "RECORD", "NULLABLE", (WireField("supp", "INTEGER"),)))),
]


@query("decode_rows_nested", """
SELECT l_orderkey AS orderkey, round(l_quantity + l_discount + l_tax, 4) AS amount, l_partkey AS part_key,
       l_returnflag AS part_flag, CAST(2 AS BIGINT) AS n_steps, 'ship' AS second_name,
       CAST(l_linenumber AS BIGINT) AS second_code, l_suppkey AS first_supp, false AS _decode_error
FROM lineitem
""")
def decode_rows_nested(spark, sf_dir):
    """Lines with repeated scalars, a record, and repeated records holding both."""

    def box(raw):  # {"v": <raw json>}
        return F.concat(F.lit('{"v":'), raw, F.lit("}"))

    def listed(*raws):
        return F.concat(F.lit("["), F.concat_ws(",", *raws), F.lit("]"))

    def rec(*raws):
        return F.concat(F.lit('{"f":'), listed(*raws), F.lit("}"))

    def quoted(c):
        return F.concat(F.lit('{"v":"'), F.col(c).cast("string"), F.lit('"}'))

    steps = listed(
        box(rec(F.lit('{"v":"pack"}'), box(F.lit("[]")), box(rec(quoted("l_suppkey"))))),
        box(rec(F.lit('{"v":"ship"}'), box(listed(quoted("l_linenumber"))), F.lit('{"v":null}'))))
    lines = table(spark, sf_dir, "lineitem").select(rec(
        quoted("l_orderkey"),
        box(listed(quoted("l_quantity"), quoted("l_discount"), quoted("l_tax"))),
        box(rec(quoted("l_partkey"), quoted("l_returnflag"))),
        box(steps)).alias("line"))
    out = wire.decode_rows(lines, "line", LINE_FIELDS)
    return out.select(
        "orderkey", F.round(F.aggregate("amounts", F.lit(0.0), lambda a, x: a + x), 4).alias("amount"),
        F.col("part.key").alias("part_key"), F.col("part.flag").alias("part_flag"),
        F.size("steps").cast("long").alias("n_steps"), F.col("steps")[1]["name"].alias("second_name"),
        F.col("steps")[1]["codes"][0].alias("second_code"), F.col("steps")[0]["at"]["supp"].alias("first_supp"),
        "_decode_error")


FAULT_FIELDS = [
    WireField("id", "INTEGER"), WireField("part", "RECORD", "NULLABLE", (WireField("day", "DATE"), WireField("n", "INTEGER"))),
    WireField("days", "DATE", "REPEATED"), WireField("at", "TIMESTAMP")]


@query("decode_rows_faults", """
SELECT event_id, CASE WHEN event_id % 8 < 6 THEN event_id END AS id, CASE WHEN event_id % 8 NOT IN (1, 6, 7) THEN strftime(ts, '%Y-%m-%d') END AS part_day,
       CASE WHEN event_id % 8 < 6 THEN CAST(2 AS BIGINT) END AS n_days,
       CASE WHEN event_id % 8 NOT IN (4, 5, 6, 7) THEN event_id END AS at,
       event_id % 8 <> 0 AS _decode_error FROM events
""")
def decode_rows_faults(spark, sf_dir):
    """One fault for each id modulo 8: none, a bad date in a record, a bad date in a list, a surplus nested cell, a number and
    a text outside the calendar, a malformed line, a missing line."""
    fault, key = F.col("event_id") % 8, F.col("event_id").cast("string")
    day = F.date_format("ts", "yyyy-MM-dd")

    def box(raw):
        return F.concat(F.lit('{"v":'), raw, F.lit("}"))

    def text(raw):
        return box(F.concat(F.lit('"'), raw, F.lit('"')))

    part = F.concat(F.lit('{"f":['), text(F.when(fault == 1, F.lit("2024-02-30")).otherwise(day)), F.lit(","), text(key),
                    F.when(fault == 3, F.lit(',{"v":"more"}')).otherwise(""), F.lit("]}"))
    days = F.concat(F.lit("["), text(day), F.lit(","), text(F.when(fault == 2, F.lit("soon")).otherwise(day)), F.lit("]"))
    at = F.when(fault == 4, box(F.lit("999999999999"))).when(fault == 5, text(F.lit("999999999999"))).otherwise(text(key))
    line = F.concat(F.lit('{"f":['), text(key), F.lit(","), box(part), F.lit(","), box(days), F.lit(","), at, F.lit("]}"))
    line = F.when(fault == 6, F.substring(line, 1, 20)).when(fault < 6, line)
    rows = wire.decode_rows(table(spark, sf_dir, "events").select("event_id", line.alias("line")), "line", FAULT_FIELDS, keep=["event_id"])
    return rows.select("event_id", "id", F.date_format("part.day", "yyyy-MM-dd").alias("part_day"),
                       F.nullif(F.size("days"), F.lit(-1)).cast("bigint").alias("n_days"), F.unix_seconds("at").alias("at"), "_decode_error")


@query("dedupe_columns_last", "SELECT event_id, round(value * 2, 2) AS value FROM events")
def dedupe_columns_last(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return wire.dedupe_columns_last(events.select(
        "value", "event_id", F.round(F.col("value") * 2, 2).alias("value")))
