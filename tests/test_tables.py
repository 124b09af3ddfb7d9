import dataclasses
import datetime
import random
from typing import Optional

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.operators import features, sinks, tables, wire
from lakekit.operators.wire import WireField
from lakekit import session
from lakekit.session import scratch_path, shared_dir, shuffle_partitions_for
from lakekit.functions.render import rows_to_json
from lakekit.sources import catalog, csv_records, grid, inputs, inventory, objects


def test_formats(spark):
    df = spark.range(3).withColumn("s", F.lit('q"u,o\nte'))
    for extension in ("json", "parquet", "csv"):
        path = sinks.write_result(df, scratch_path(spark, "f") + "." + extension)
        with pytest.raises(Exception, match="already exists"):
            sinks.write_result(df, path)
        sinks.write_result(df.limit(2), path, remove=True)
    for bad in ("x.njson", "x", "x.JSON", "x.txt"):
        with pytest.raises(inputs.UnsupportedFormat):
            sinks.write_result(df, bad)
    for bad in ("x", "x.CSV", "x.orc"):
        with pytest.raises(inputs.UnsupportedFormat, match="unsupported"):
            inputs.read_input(spark, bad)


def test_glob_is_one_table_and_url_paths_work(spark):
    base = scratch_path(spark, "glob")
    sinks.write_result(spark.range(2), base + "/a.parquet")
    sinks.write_result(spark.range(2, 5), base + "/b.parquet")
    inputs.register_inputs(spark, ["file://" + base + "/*.parquet", base + "/a.parquet"])
    assert spark.sql("SELECT (SELECT count(*) FROM t0), (SELECT count(*) FROM t1)").first() == (5, 2)
    assert [r.column_name for r in inputs.describe_table(spark, "t1").collect()] == ["id"]
    assert {"t0", "t1"} <= {r.table_name for r in inputs.information_schema_tables(spark).collect()}


@pytest.fixture
def mounted(spark, tmp_path):
    """A second file system scheme of the Hadoop client: a mount table whose /in is a local folder."""
    lake = "lake" + "".join(c for c in tmp_path.name if c.isalnum())  # file systems are kept by scheme and authority
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{lake}.link./in", tmp_path.as_uri())
    return f"viewfs://{lake}/in"


@pytest.mark.parametrize("extension", ["json", "parquet", "csv"])
def test_urls_of_another_file_system(spark, mounted, tmp_path, extension):
    df = spark.createDataFrame([(1, 'a "b"\r\nc', 1.5), (2, None, None), (3, "", 2.0)], "a bigint, s string, d double")
    path = sinks.write_result(df, f"{mounted}/one.{extension}")
    assert path.startswith("viewfs://") and (tmp_path / f"one.{extension}").is_dir()
    with pytest.raises(Exception, match="already exists"):
        sinks.write_result(df, path)
    sinks.write_result(df.withColumn("a", F.col("a") + 10), f"{mounted}/two.{extension}")
    schemas = {0: df.schema, 1: df.schema}
    both = inputs.run_query(spark, [path, f"{mounted}/*.{extension}"],
                            "SELECT (SELECT count(*) FROM t0) AS one, count(*) AS n, sum(a) AS total, max(s) AS s FROM t1", schemas)
    assert both.first() == (3, 6, 42, 'a "b"\r\nc')
    sinks.write_result(df.limit(1), path, remove=True)
    assert inputs.read_input(spark, path, df.schema).count() == 1


def test_urls_without_a_file_system_are_refused(spark):
    for extension in ("json", "parquet", "csv"):
        with pytest.raises(Exception, match="(?i)scheme"):
            inputs.read_input(spark, f"nosuch://bucket/x.{extension}", "a int").count()


def test_tables_expire(spark):
    database = "expiring"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    schema = T.StructType([T.StructField("a", T.LongType())])
    for name, expires in (("gone", 100), ("kept", 101), ("forever", None)):
        tables.create_table(spark, f"{database}.{name}", schema, expires=expires)

    def listed():
        return {r.table_name: r.expires_epoch for r in catalog.list_tables(spark, database).collect()}

    assert listed() == {"gone": 100, "kept": 101, "forever": None}
    assert tables.drop_expired(spark, database, 100) == ["gone"]
    tables.set_expiry(spark, f"{database}.kept", None)
    tables.set_expiry(spark, f"{database}.forever", 0)
    assert listed() == {"kept": None, "forever": 0}
    assert tables.drop_expired(spark, database, 10**12) == ["forever"]
    assert tables.drop_expired(spark, database, 10**12) == []
    for bad in (lambda: tables.create_table(spark, f"{database}.x", schema, expires=-1), lambda: tables.set_expiry(spark, f"{database}.kept", -1)):
        with pytest.raises(ValueError, match="epoch"):
            bad()
    assert listed() == {"kept": None}
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_csv_types_are_inferred_and_text_survives(spark):
    df = spark.createDataFrame([(1, "", 1.5), (2, None, None), (3, 'a "b"', 2.0)], "a int, s string, d double")
    back = inputs.read_input(spark, sinks.write_result(df, scratch_path(spark, "c") + ".csv"))
    assert [f.dataType.simpleString() for f in back.schema] == ["int", "string", "double"]
    assert sorted(map(tuple, back.collect())) == [(1, "", 1.5), (2, None, None), (3, 'a "b"', 2.0)]


def test_dispositions(spark):
    df = spark.range(3)
    name = "t_disp"
    tables.query_to_table(df, name, dry_run=True)
    assert not spark.catalog.tableExists(name)
    tables.query_to_table(df, name)
    with pytest.raises(tables.TableNotEmpty):
        tables.query_to_table(df, name, dry_run=True)
    tables.query_to_table(df, name, "append")
    assert catalog.read_table(spark, name).count() == 6
    tables.query_to_table(df.limit(1), name, "truncate")
    assert spark.table(name).count() == 1
    tables.query_to_table(df.where("false"), name, "truncate")
    tables.query_to_table(df, name, "empty")
    assert spark.table(name).count() == 3
    with pytest.raises(ValueError):
        tables.query_to_table(df, name, "merge")
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


@dataclasses.dataclass
class Inner:
    nested: str


@dataclasses.dataclass
class Declared:
    id: int
    at: Optional[datetime.datetime]
    tags: list[str]
    parent: Inner
    name: str = dataclasses.field(metadata={"description": "display"}, default="")


def test_schema_from_dataclass(spark):
    schema = tables.schema_from_dataclass(Declared)
    assert schema == T.StructType([
        T.StructField("id", T.LongType(), False), T.StructField("at", T.TimestampType(), True),
        T.StructField("tags", T.ArrayType(T.StringType()), True),
        T.StructField("parent", T.StructType([T.StructField("nested", T.StringType(), False)]), False),
        T.StructField("name", T.StringType(), False, {"comment": "display"})])
    assert catalog.flatten_schema(schema) == [
        ("id", "bigint", "REQUIRED", None), ("at", "timestamp", "NULLABLE", None), ("tags", "string", "REPEATED", None),
        ("parent", "RECORD", "REQUIRED", None), ("parent.nested", "string", "REQUIRED", None),
        ("name", "string", "REQUIRED", "display")]
    tables.create_table(spark, "t_declared", tables.all_nullable(schema), "text")
    assert "display" in str(spark.sql("DESCRIBE t_declared").collect())
    tables.drop_table(spark, "t_declared")


LINES = ['{"id": 1, "name": "a", "score": 1.5}', '{"id": "x", "name": "a"}', '{"name": "a"}', '{"id": 2, "more": 1}',
         '{"id": 3', '{"id": null}', '{"id": 4, "score": null}', "[1]", "", "7"]
SCHEMA = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType()),
                       T.StructField("score", T.DoubleType())])


def test_validated_insert(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "line string")
    got = {r.line: r.reason for r in tables.validate_lines(lines, "line", SCHEMA).collect()}
    assert got == {LINES[0]: None, LINES[1]: "wrong type", LINES[2]: "missing required", LINES[3]: "unknown field",
                   LINES[4]: "malformed", LINES[5]: "missing required", LINES[6]: None, "[1]": "malformed", "": "malformed", "7": "malformed"}
    with pytest.raises(tables.InvalidRows):
        tables.insert_lines(lines, "line", "t_ins", SCHEMA)
    assert spark.table("t_ins").count() == 0
    refused = tables.insert_lines(lines, "line", "t_ins", SCHEMA, skip_invalid=True, ignore_unknown=True)
    assert refused.count() == 7
    assert sorted(r.id for r in spark.table("t_ins").collect()) == [1, 2, 4]
    tables.drop_table(spark, "t_ins")


def decode(spark, field, *cells, **options):
    lines = spark.createDataFrame([('{"f":[{"v":%s}]}' % c,) for c in cells], "line string")
    rows = wire.decode_rows(lines, "line", [field], **options).collect()
    return [r[0] for r in rows], [r["_decode_error"] for r in rows]


@pytest.mark.parametrize("kind, cells, want", [
    ("STRING", ['"a"', "42", "3.5", "true", "null"], ["a", "42", "3.5", None, None]),
    ("INTEGER", ['"42"', "42", '"abc"', '" 42"', "1.5", '"99999999999999999999"', "true"], [42, 42, 0, 0, 0, 0, None]),
    ("FLOAT", ['"3.14"', "3.14", '"1d"', '"x"', '"1e3"', '".5"', '"inf"', "7"], [3.14, 3.14, 0.0, 0.0, 1000.0, 0.5, float("inf"), 7.0]),
    ("BOOLEAN", ['"true"', '"TRUE"', "false", "true", "1"], [True, False, False, True, None]),
    ("TIME", ['"14:30:00"', '"14:30:00.25"', "5"], ["14:30:00", "14:30:00", None]),
    ("DATE", ['"2023-12-25"', "1703505000"], [datetime.date(2023, 12, 25)] * 2),
    ("DATETIME", ['"2023-12-25T14:30:00.123456"'], [datetime.datetime(2023, 12, 25, 14, 30, 0, 123456)]),
    ("JSON", ['"x"', "1", '{"k":1}'], [None, None, None]),
    ("UNKNOWN", ['"x"'], [None]),
])
def test_decode_scalars(spark, kind, cells, want):
    assert decode(spark, WireField("c", kind), *cells)[0] == want


def test_decode_timestamps(spark):
    lines = spark.createDataFrame([('{"f":[{"v":%s}]}' % c,) for c in ('"1703505000.9"', '"-1.5"', "1703505000", '"x"', "1.5", '"1e99"')], "line string")
    rows = wire.decode_rows(lines, "line", [WireField("c", "TIMESTAMP")]).select(F.unix_seconds("c"), "_decode_error").collect()
    assert [tuple(r) for r in rows] == [(1703505000, False), (-1, False), (1703505000, False), (0, False), (0, False), (None, True)]


def test_decode_errors_and_json_text(spark):
    assert decode(spark, WireField("c", "DATE"), '"2023-13-01"', '"x"', "null") == ([None] * 3, [True, True, False])
    assert decode(spark, WireField("c", "JSON"), '"{\\"k\\":1}"', json_text=True)[0] == ['{"k":1}']
    lines = spark.createDataFrame([('{"f":[{"v":"1"},{"v":"2"}]}',), ("{}",), ("bad",)], "line string")
    rows = wire.decode_rows(lines, "line", [WireField("c", "INTEGER")]).collect()
    assert [tuple(r) for r in rows] == [(1, True), (None, False), (None, True)]


def test_decode_faults_at_any_depth(spark):
    day = WireField("r", "RECORD", "NULLABLE", (WireField("d", "DATE"), WireField("ds", "DATE", "REPEATED")))
    good, flags = decode(spark, day, '{"f":[{"v":"2024-02-29"},{"v":[{"v":"2024-01-01"}]}]}', '{"f":[{"v":"2023-02-29"},{"v":[]}]}',
                         '{"f":[{"v":null},{"v":[{"v":"no"}]}]}', '{"f":[{"v":null},{"v":[]},{"v":"more"}]}', "null", '{"f":[{"v":5}]}')
    assert flags == [False, True, True, True, False, False]
    assert good[0] == (datetime.date(2024, 2, 29), [datetime.date(2024, 1, 1)]) and good[5][0] == datetime.date(1970, 1, 1)
    assert decode(spark, WireField("c", "TIMESTAMP"), "999999999999", '"999999999999"', "1.5")[1] == [True, True, False]
    assert decode(spark, WireField("c", "INTEGER"), '["1"]', '"42\\n"') == ([None, 0], [True, False])
    assert decode(spark, WireField("c", "STRING"), "1.0", "1e20", "1.5e3", "-2.5e-7", "0.0001", "12345678901234567890") == (
        ["1.0", "1e20", "1500.0", "-2.5e-7", "0.0001", "12345678901234567890"], [False] * 6)
    lines = spark.createDataFrame([('  {"f" : [ {"v" : "a\\"}b"} ] }',), (None,), ("[]",), ('{"f":null}',)], "line string")
    rows = wire.decode_rows(lines, "line", [WireField("c", "STRING")]).collect()
    assert [tuple(r) for r in rows] == [('a"}b', False), (None, True), (None, True), (None, False)]


def test_decode_nested(spark):
    field = WireField("r", "RECORD", "REPEATED", (WireField("a", "INTEGER"), WireField("b", "STRING", "REPEATED")))
    got, _ = decode(spark, field, '[{"v":{"f":[{"v":"1"},{"v":[{"v":"x"},{"v":null}]}]}},{"v":{"f":[{"v":null},{"v":[]}]}}]', "null")
    assert got[0] == [(1, ["x", None]), (None, [])] and got[1] is None
    assert decode(spark, WireField("c", "STRING", "REPEATED"), '["item1","item2","item3"]')[0] == [["item1", "item2", "item3"]]


def test_schema_mapping_both_ways():
    spec = {"name": "parent", "type": "RECORD", "mode": "REPEATED", "description": "d",
            "fields": [{"name": "nested", "type": "NUMERIC", "mode": "REQUIRED"}, {"name": "odd", "type": "GEOGRAPHY"}]}
    field = wire.read_field(spec)
    assert [f.type for f in field.fields] == ["FLOAT", "UNKNOWN"] and field.fields[1].mode == "UNKNOWN"
    assert wire.write_field(field) == {
        "name": "parent", "type": "RECORD", "mode": "REPEATED", "description": "d",
        "fields": [{"name": "nested", "type": "NUMERIC", "mode": "REQUIRED"}, {"name": "odd"}]}
    schema = wire.to_struct([field])
    assert wire.from_struct(schema)[0].fields[0] == WireField("nested", "FLOAT", "REQUIRED")


def test_columns_by_name(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS a")
    assert wire.dedupe_columns_last(df).columns == ["b", "a"]
    assert wire.dedupe_columns_last(df).first() == (2, 3)
    single = spark.sql("SELECT 1 AS a")
    assert single.select(wire.get_column(single, "a"), wire.get_column(single, "zz")).first() == (1, None)


def test_grid_short_rows_and_order(spark):
    sheets = spark.createDataFrame([(1, [["b", "a"], ["x", "1"], ["y"]]), (2, [["a"]]), (3, [])], "id int, g array<array<string>>")
    got = grid.grid_to_table(sheets, "g", {"a": "int", "b": "string", "c": "string"}).drop("row_number").collect()
    assert [tuple(r) for r in got] == [(1, 1, "x", None), (1, None, "y", None)]


def test_objects(spark):
    inv = spark.createDataFrame([("b", "a/x.txt"), ("b", "a/b/y"), ("b", "c"), ("d", "a/z/1"), ("d", None)], "bucket string, name string")
    assert {r.name for r in inventory.list_common_prefixes(inv, "/", "/a/").collect()} == {"a/b/", "a/z/"}
    assert inventory.list_objects(inv, prefix="a/", bucket="b").count() == 2
    assert inventory.list_objects(inv, start="a/b", end="c").count() == 3
    path = scratch_path(spark, "bin")
    spark.createDataFrame([("é" * 700,)], "value string").coalesce(1).write.text(path)
    chunks = inventory.read_binary_chunks(spark, path + "/*.txt", chunk=512).orderBy("position").collect()
    assert b"".join(bytes(c.bytes) for c in chunks).decode() == "é" * 700 + "\n" and len(chunks) == 3
    bad = scratch_path(spark, "bad")
    spark.createDataFrame([(bytearray([0xC3, 0x28]),)], "v binary").select(F.col("v").cast("string").alias("value")).write.text(bad)
    with pytest.raises(Exception, match="INVALID_UTF8_STRING|UTF"):
        inventory.read_text_objects(spark, bad + "/*.txt").collect()


def test_features_refuse_bad_input(spark):
    df = spark.createDataFrame([(1, "s", None)], "a int, b string, c double")
    with pytest.raises(TypeError):
        features.features(df, ["b"])
    with pytest.raises(ValueError):
        features.features(df, [])
    with pytest.raises(Exception, match="null in numeric column c"):
        features.features(df, ["c"]).collect()


def test_with_rank_is_a_total_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x")).repartition(7)
    assert [(r.x, r.r) for r in features.with_rank(df, ["x"], "r").orderBy("x").collect()] == [
        (x, i) for i, x in enumerate(sorted(i * 7919 % 5003 for i in range(5000)))]
    assert features.with_rank(df.where("false"), ["x"], "r").count() == 0


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shuffle_partitions_grow_with_the_data():
    assert shuffle_partitions_for(10 << 30) == 200
    assert shuffle_partitions_for(100 << 40) == 204800


def test_rows_match_tables_by_name(spark):
    df, name = spark.createDataFrame([(1, "x")], "a long, b string"), "t_by_name"
    tables.query_to_table(df, name)
    tables.query_to_table(df.select("b", "a"), name, "append")
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "x")] * 2
    with pytest.raises(ValueError):
        tables.query_to_table(df.select("a"), name, "append")
    tables.query_to_table(df.select(F.lit(2.5).alias("c")), name, "truncate")
    assert [tuple(r) for r in spark.table(name).collect()] == [(2.5,)]
    tables.drop_table(spark, name)


def test_text_survives_csv(spark):
    values = [" pad ", "a\nb", "a\r\nb\rc", "", None, '"', "\\", "\\N", ",", "# x", "null", "\t", "é😀"]
    df = spark.createDataFrame(list(enumerate(values)), "k long, v string")
    path = sinks.write_result(df, scratch_path(spark, "text") + ".csv")
    assert [r.v for r in inputs.read_input(spark, path, df.schema).orderBy("k").collect()] == values


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 20])
def test_records_are_cut_inside_a_file(spark, tmp_path, size):
    rng = random.Random(size)
    cells = ["", "x", "a\nb", "a\r\nb\rc", 'q"u"o', '"', ",", " pad ", "é😀", "\n", "\r\n", None]
    rows = [(k, rng.choice(cells), rng.choice(cells)) for k in range(60)]

    def text(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"'

    for end, mark in (("\n", ""), ("\r\n", "\ufeff")):
        path = tmp_path / f"f{len(end)}.csv"
        body = mark + end.join(["k,v,w", *(f"{k},{text(v)},{text(w)}" for k, v, w in rows)]) + (end if size % 2 else "")
        path.write_bytes(body.encode())
        got = csv_records.read_csv(spark, str(path), "k long, v string, w string", size)
        assert sorted(tuple(r) for r in got.collect()) == rows
    assert csv_records._ranges(spark, str(path), 100).count() == -(-len(body.encode()) // 100)


def test_crlf_one_column_and_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"a,b\r\n1,x\r\n2,\"y\r\nz\"\r\n")
    got = inputs.read_input(spark, str(tmp_path / "a.csv"))
    assert got.columns == ["a", "b"] and dict(got.dtypes)["a"] == "int" and sorted(tuple(r) for r in got.collect()) == [(1, "x"), (2, "y\r\nz")]
    df = spark.createDataFrame([("x",), (None,), ("y",), ("",)], "v string").coalesce(1)
    path = sinks.write_result(df, scratch_path(spark, "one") + ".csv")
    assert sorted((r.v or "", r.v is None) for r in inputs.read_input(spark, path).collect()) == [("", False), ("", True), ("x", False), ("y", False)]
    (tmp_path / "e.csv").write_bytes(b"")
    assert inputs.read_input(spark, str(tmp_path / "e.csv")).collect() == []
    (tmp_path / "h.csv").write_bytes(b"a,,A\n")
    assert inputs.read_input(spark, str(tmp_path / "h.csv")).columns == ["a0", "_c1", "A2"]


def test_times_in_maps_keep_their_digits(spark):
    df = spark.sql("SELECT map('k', timestamp '2024-01-02 00:00:00.123456') AS m, map(timestamp '2024-01-02 00:00:00.5', 1) AS n")
    assert [r.json for r in rows_to_json(df).collect()] == ['{"m":{"k":"2024-01-02T00:00:00.123456+00:00"},"n":{"2024-01-02T00:00:00.500+00:00":1}}']


def test_objects_by_name_and_prefix(spark):
    path = scratch_path(spark, "named")
    df = spark.createDataFrame([("a/1.txt", bytearray(b"x" * 5000), "text/html"), ("a/2z.bin", bytearray(b""), "bad"), ("b/1.webm", None, None)],
                               "name string, body binary, kind string")
    put = inventory.put_objects(df, "name", "body", path, "kind")
    assert {r.name: (r.content_type, r["size"]) for r in put.collect()} == {
        "a/1.txt": ("text/html", 5000), "a/2z.bin": ("application/octet-stream", 0), "b/1.webm": ("video/webm", 0)}
    listed = inventory.inventory_from_files(spark, path, prefix="/a/2")
    assert [r.path.rsplit("/", 1)[1] for r in listed.collect()] == ["2z.bin"]
    assert inventory.inventory_from_files(spark, path, prefix="c").collect() == []
    chunks = inventory.read_binary_chunks(spark, f"{path}/a/1.txt", 1024).orderBy("position").collect()
    assert [len(c.bytes) for c in chunks] == [1024] * 4 + [904] and b"".join(bytes(c.bytes) for c in chunks) == b"x" * 5000


def test_odd_objects_are_listed_and_read(spark):
    path = scratch_path(spark, "odd place")
    bodies = {"_x.txt": b"1", ".y.txt": b"", "_b/k.txt": b"23", "z.txt": "é".encode(), "s p%20c.txt": b"456", "a/.b/_c/d#e?.txt": b"7"}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in bodies.items()], "name string, body binary")
    inventory.put_objects(df, "name", "body", path)
    assert {r.name: r.length for r in inventory.inventory_from_files(spark, path).collect()} == {k: len(v) for k, v in bodies.items()}
    cut = len(path) + 1
    assert {r.path[cut:]: r.text for r in inventory.read_text_objects(spark, path).collect()} == {k: v.decode() for k, v in bodies.items()}
    assert {r.path[cut:]: bytes(r.bytes) for r in inventory.read_binary_chunks(spark, path).collect()} == bodies
    assert [r.text for r in inventory.read_text_objects(spark, f"{path}/s p%20c.txt").collect()] == ["456"]
    assert {r.path[cut:] for r in inventory.read_text_objects(spark, f"{path}/*.txt").collect()} == {"_x.txt", ".y.txt", "z.txt", "s p%20c.txt"}
    assert {r.path[len("file://") + cut:] for r in inventory.inventory_from_files(spark, f"file://{path}", "?y.*").collect()} == {".y.txt"}
    inventory.put_objects(spark.createDataFrame([("bad", bytearray(b"\xff"))], df.schema), "name", "body", path)
    with pytest.raises(Exception, match="not UTF-8"):
        inventory.read_text_objects(spark, f"{path}/bad").collect()


@pytest.mark.parametrize("name", [None, "", "../esc.txt", "a/../../b", "/abs", "a//b", "a/.", "a/"])
def test_names_that_leave_the_folder_are_refused(spark, name):
    path = scratch_path(spark, "refused")
    df = spark.createDataFrame([("good", bytearray(b"x")), (name, bytearray(b"y"))], "name string, body binary")
    with pytest.raises(ValueError):
        inventory.put_objects(df, "name", "body", path)
    assert inventory.inventory_from_files(spark, path).collect() == []


def test_names_go_to_the_lister(spark, monkeypatch):
    path = scratch_path(spark, "tree")
    names = [f"{a}/{b}/{c}" for a in "abc" for b in range(6) for c in range(3)] + ["top"]
    inventory.put_objects(spark.createDataFrame([(n, bytearray(b"x")) for n in names], "name string, body binary"), "name", "body", path)
    every = objects.read_objects(spark, path, splits=5)
    for condition in (F.col("name").startswith("b/2"), F.col("name").startswith("b/"), F.col("name") == "c/5/1", F.col("name") >= "b/3", F.col("name") < "a/2/1",
                      F.col("name").between("a/4/2", "b/1/0"), (F.col("name") > "a/5/2") & F.col("name").startswith("a/5"), F.col("name") == "none",
                      F.col("name").startswith("zz/top"), F.col("length") > 0, F.col("name").isin("top", "a/0/0")):
        want = spark.createDataFrame([(n, 1) for n in names], "name string, length bigint").where(condition)
        assert sorted(r.name for r in every.where(condition).collect()) == sorted(r.name for r in want.collect())
    reader = objects.ObjectReader(path, 5)
    seen = []
    real = objects.ObjectReader._list
    monkeypatch.setattr(objects.ObjectReader, "_list", lambda self, f: seen.append(f) or real(self, f))
    parts = reader.partitions()
    assert len(seen) == 5 and sorted(r[0] for p in parts for r in reader.read(p)) == sorted(names)
    seen.clear()
    reader = objects.ObjectReader(path, 5)
    assert list(reader.pushFilters([ds.StringStartsWith(("name",), "b/2/"), ds.EqualTo(("length",), 1)])) == [ds.EqualTo(("length",), 1)]
    assert len([r[0] for p in reader.partitions() for r in reader.read(p) if r[0]]) == 3
    assert set(seen) == {"b/2/"}  # no other folder is entered


def test_scratch_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", [])
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) == 1 and session._SCRATCH == []
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_objects_are_handed_on_in_batches(spark, tmp_path):
    """A listing is rows by the batch, not one by one; small objects are read many to a batch."""
    for k in range(50):
        (tmp_path / f"_{k}.txt").write_text("x" * k)
    reader = objects.ObjectReader(str(tmp_path), 8)
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert [b.num_rows for b in batches] == [50]
    listed = objects.read_objects(spark, str(tmp_path)).collect()
    assert {(r.name, r.length) for r in listed} == {(f"_{k}.txt", k) for k in range(50)}
    assert {r.modificationTime.timestamp() for r in listed} == {(tmp_path / f"_{k}.txt").stat().st_mtime_ns // 1000 / 1e6 for k in range(50)}
    texts = inventory.read_text_objects(spark, str(tmp_path)).collect()
    assert {(r.path, r.text) for r in texts} == {(str(tmp_path / f"_{k}.txt"), "x" * k) for k in range(50)}


def test_lines_without_blanks_are_read_in_one_parse(spark):
    """Plain lines and the same lines with blanks, which are read level by level, give the same rows."""
    fields = [wire.WireField("id", "INTEGER"), wire.WireField("days", "DATE", "REPEATED"), wire.WireField("part", "RECORD", "NULLABLE", (
        wire.WireField("name", "STRING"), wire.WireField("at", "TIME"))), wire.WireField("steps", "RECORD", "REPEATED", (
            wire.WireField("codes", "INTEGER", "REPEATED"), wire.WireField("in", "RECORD", "NULLABLE", (wire.WireField("x", "FLOAT"), wire.WireField("on", "DATE")))))]
    trap = r'"a\"{\"v\":[\\"'
    plain = [
        '{"f":[]}', '{"f":[{"v":null},{"v":null},{"v":null},{"v":null}]}', '{"f":[{"v":"7"},{"v":[]},{"v":{"f":[]}},{"v":[]}]}',
        f'{{"f":[{{"v":"x"}},{{"v":[{{"v":"2024-01-02"}},{{"v":null}}]}},{{"v":{{"f":[{{"v":{trap}}},{{"v":"1:2:3"}}]}}}},{{"v":['
        '{"v":{"f":[{"v":[{"v":"1"},{"v":"?"}]},{"v":{"f":[{"v":"2.5"},{"v":"2024-02-03"}]}}]}},{"v":null},{"v":{"f":[{"v":null},{"v":null}]}}]}]}',
        '{"f":[{"v":"1"},{"v":[{"v":"bad"}]},{"v":null},{"v":null}]}', '{"f":[{"v":"1"},{"v":[]},{"v":{"f":[{"v":"n"},{"v":"late"}]}}]}',
        '{"f":[{"v":"1"},{"v":[]},{"v":null},{"v":[{"v":{"f":[{"v":[]},{"v":{"f":[{"v":"1"},{"v":"no day"}]}}]}}]}]}', r'{"f":[{"v":"\x"}]}']
    kept = spark.createDataFrame([(k, w, t) for k, t in enumerate(plain) for w, t in (("plain", t), ("blank", t.replace("},{", "} , {") + " "))],
                                 "k int, w string, line string")
    assert [r[0] for r in kept.orderBy("w", "k").select(kept.line.rlike(wire._plain_line(fields))).collect()] == [False] * len(plain) + [True] * len(plain)
    rows = {(r.w, r.k): r[2:] for r in wire.decode_rows(kept, "line", fields, keep=["w", "k"]).collect()}
    for k in range(len(plain)):
        assert rows["plain", k] == rows["blank", k], plain[k]
    assert [rows["plain", k][-1] for k in range(len(plain))] == [False] * 4 + [True] * 3 + [False]
    assert rows["plain", 3][2].name == 'a"{"v":[\\' and rows["plain", 3][3][0].codes == [1, 0] and rows["plain", 3][3][1] is None
