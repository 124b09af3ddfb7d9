import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakekit.functions import render, scalars
from lakekit.functions.aggregates import grouped_string_agg, newline_fold, string_agg_newline
from lakekit.operators import resources, responses, text


def values(df):
    return [tuple(r) for r in df.collect()]


def test_cpow_keeps_c_semantics(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (-1.0, float("inf")), (2.0, 3.0), (None, 2.0), (1.0, None)], "b double, e double")
    got = [r[0] for r in df.select(scalars.cpow(F.col("b"), F.col("e"))).collect()]
    assert got == [1.0, 1.0, 8.0, None, None]
    assert got == [r[0] for r in df.selectExpr("cpow(b, e)").collect()]


def test_string_agg_drops_leading_empties_only(spark):
    df = spark.createDataFrame([("a", 1, ""), ("a", 2, "x"), ("a", 3, ""), ("a", 4, "y"), ("a", 5, None), ("b", 1, ""), ("c", 1, None)],
                               "k string, o int, t string")
    want = {"a": "x\n\ny", "b": "", "c": ""}
    assert dict(values(df.groupBy("k").agg(string_agg_newline(F.col("t"), F.col("o"))))) == want
    assert dict(values(grouped_string_agg(df, ["k"], "t", ["o"], "t2"))) == want
    assert df.where("false").agg(string_agg_newline(F.col("t"), F.col("o"))).first()[0] == ""


def test_string_agg_of_a_hot_group_cut_over_partitions(spark):
    n = 5000
    rows = [("hot", i, "" if i < 1500 or i % 3 == 0 or 3000 < i < 4500 else f"t{i}") for i in range(n)] + [("cold", 0, "z")]
    df = spark.createDataFrame(rows, "k string, o int, t string").repartition(6)
    got = dict(values(grouped_string_agg(df, ["k"], "t", ["o"], "t2")))
    acc = ""
    for _, _, t in rows[:-1]:
        acc = acc + "\n" + t if acc else t
    assert got == {"hot": acc, "cold": "z"}


def test_newline_fold_sql_and_column_agree(spark):
    df = spark.createDataFrame([(["", None, "a", "", "b", ""],), ([],)], "p array<string>")
    assert [r[0] for r in df.select(newline_fold(F.col("p"))).collect()] == ["a\n\nb\n", ""]
    assert [r[0] for r in df.selectExpr("newline_join(p)").collect()] == ["a\n\nb\n", ""]


def test_mime_and_urls(spark):
    df = spark.createDataFrame([("text/html",), ("IMAGE/PNG",), ("text/html; charset=utf-8",), ("bogus",), ("",), (None,)], "ct string")
    assert [r[0] for r in df.select(scalars.mime_normalize(F.col("ct"))).collect()] == [
        "text/html", "IMAGE/PNG", "text/html; charset=utf-8", "application/octet-stream", "application/octet-stream", None]
    df = spark.createDataFrame([("a/b.PDF",), ("x.tar.gz",), ("noext",), ("dir.v2/file",), (".png",), (None,)], "p string")
    assert [r[0] for r in df.select(scalars.mime_guess(F.col("p"))).collect()] == [
        "application/pdf", "application/gzip"] + ["application/octet-stream"] * 4
    df = spark.createDataFrame([("gs://b/x/y.txt",), ("gs://b",), ("plain-name",), ("https://h:80/p?q#f",), ("gs://b//p",)], "u string")
    assert [tuple(r[0]) for r in df.select(scalars.split_object_url(F.col("u"))).collect()] == [
        ("b", "x/y.txt"), ("b", ""), ("plain-name", ""), ("h", "p"), ("b", "/p")]
    df = spark.createDataFrame([("/path",), ("///path",), ("",), ("path",)], "p string")
    assert [r[0] for r in df.select(scalars.prefix_normalize(F.col("p"))).collect()] == ["path", "//path", "", "path"]
    df = spark.createDataFrame([("b", "my file.txt"), ("", "n"), ("b", None)], "b string, n string")
    assert [r[0] for r in df.select(scalars.object_url(F.col("b"), F.col("n"))).collect()] == [
        "gs://b/my file.txt", "gs:///n", "gs://b/"]


def test_resource_names(spark):
    df = spark.createDataFrame([("projects/p/locations/l/jobs/j/executions/e",), ("projects/p/locations/l",), (None,)], "n string")
    got = [tuple(r[0]) for r in df.select(scalars.parse_resource_name(F.col("n"), "execution")).collect()]
    assert got == [("p", "l", "j", "e", True), (None,) * 4 + (False,), (None,) * 4 + (False,)]


def test_status_defaults(spark):
    df = spark.createDataFrame([("DONE",), ("done",), (None,)], "s string")
    assert [r[0] for r in df.select(scalars.job_status(F.col("s"))).collect()] == ["Done", "Unknown", "Unknown"]
    assert [r[0] for r in df.select(scalars.condition_state(F.col("s"))).collect()] == ["Unspecified"] * 3


def test_errors(spark):
    df = spark.createDataFrame([('{"error":{"code":404,"message":"m"}}',), ('{"error":{"message":"m"}}',), ("{}",), ('{"error":{"code":403}}',)], "b string")
    assert [tuple(r[0]) for r in df.select(scalars.classify_error(F.col("b"))).collect()] == [
        ("NotFound", 404, "m"), ("Undefined", 500, "m"), ("Undefined", 500, "Unknown error"), ("Forbidden", 403, "Unknown error")]


def test_date_bin_and_int_div(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-01 00:22:31' AS t, 7 AS a, -7 AS c, 2 AS b").select(
        scalars.date_bin(F.col("t"), 900).cast("string"), scalars.int_div(F.col("a"), F.col("b")), scalars.int_div(F.col("c"), F.col("b"))).first()
    assert tuple(row) == ("2024-01-01 00:15:00", 3, -3)


def test_row_text(spark):
    df = spark.sql("""SELECT 'a"b' AS s, CAST(NULL AS STRING) AS n, 3.0D AS whole, 1.0E-5D AS tiny, 1.5E10D AS big, true AS f,
        date'2023-12-25' AS d, timestamp_ntz'2023-12-25 14:30:00' AS t, array('a', NULL) AS l, named_struct('x', 1, 'y', CAST(NULL AS INT)) AS r""")
    assert df.transform(render.rows_to_text).first()[0] == (
        '{"s": "a"b","whole": 3,"tiny": 0.00001,"big": 15000000000,"f": true,"d": "2023-12-25",'
        '"t": "2023-12-25T14:30:00.000000","l": ["a",null],"r": {"x": 1}}')
    assert render.rows_to_json(df.select("s", "n", "whole")).first()[0] == '{"s":"a\\"b","n":null,"whole":3.0}'
    assert tuple(render.rows_to_json_cells(df.select("s", "n", "whole", "l")).first()) == ('"a\\"b"', "null", "3.0", '["a",null]')


def test_env_map_last_wins(spark):
    df = spark.createDataFrame([Row(env=[("A", "1"), ("B", None), ("A", "2"), (None, "x")]), Row(env=None), Row(env=[])],
                               "env array<struct<name:string,value:string>>")
    assert [r[0] for r in df.select(resources.env_map(F.col("env"))).collect()] == [{"B": "", "A": "2", "": "x"}, {}, {}]


def test_timeout_seconds(spark):
    df = spark.createDataFrame([("600s",), ("1.9s",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(resources.timeout_seconds(F.col("t"))).collect()] == [600, 1, None, None]


def test_volume_without_instances(spark):
    body = '{"name":"projects/p/locations/l/services/s","template":{"volumes":[{"name":"v","cloudSqlInstance":{"instances":[]}},{"name":"w"}]}}'
    row = resources.flatten_services(spark.createDataFrame([(body,), ('{"name":"x"}',)], "b string"), "b").collect()
    assert [tuple(v) for v in row[0]["volumes"]] == [("v", None), ("w", None)] and row[0]["error"] is None
    assert row[1]["error"] == "template does not exist" and not row[1]["name"]["is_valid"]


def test_responses(spark):
    df = spark.createDataFrame([("{}", "m"), ('{"candidates":[]}', "m"), ('{"candidates":[{"content":{"parts":[{"text":"t"}]}}]}', "m")], "b string, m string")
    assert [r["text"] for r in responses.decode_content(df, "b", "m").collect()] == [None, None, "t"]
    df = spark.createDataFrame([('{"predictions":[{"embeddings":{"statistics":{"token_count":3,"truncated":false},"values":[0.5,1.0]}}]}', "m"), ("{}", "m")], "b string, m string")
    got = responses.decode_embeddings(df, "b", "m").collect()
    assert got[0]["embeddings"] == [0.5, 1.0] and got[0]["token_info"]["total_tokens"] == 3 and got[1]["error"] == "no predictions"


def test_embed_request_refuses_unknown_task(spark):
    df = spark.createDataFrame([("t", "NOT_A_TASK")], "c string, k string")
    with pytest.raises(Exception, match="unknown task type"):
        df.select(responses.embed_request(F.col("c"), F.col("k"))).collect()


def test_call_model_builds_one_client_per_partition(spark):
    def client():
        made = []

        def send(body):
            made.append(body)
            return body.upper()
        return send

    df = spark.createDataFrame([("a",), ("b",)], "request string")
    assert sorted(values(responses.call_model(df, "request", client))) == [("a", "A"), ("b", "B")]


def test_tokenize_with_analyzer(spark):
    df = spark.createDataFrame([(1, "ab cd"), (2, None)], "k int, t string")
    got = values(text.tokenize(df, "k", "t", lambda t: [(w, [w.upper()]) for w in t.split()]))
    assert got == [(1, 0, "ab", ["AB"]), (1, 1, "cd", ["CD"])]
    assert values(text.tokenize(df, "k", "t"))[0] == (1, 0, "ab", [])


def test_infinite_numbers_render(spark):
    df = spark.createDataFrame([(float("inf"), math.nan)], "a double, b double")
    assert render.rows_to_text(df).first()[0] == '{"a": inf,"b": NaN}'


def test_newline_aggregates_agree_and_are_linear(spark):
    df = spark.sql("SELECT id % 2 AS g, CASE WHEN id < 4 THEN '' WHEN id % 7 = 0 THEN NULL ELSE cast(id AS STRING) END AS x, id FROM range(60000)")
    want = {g: "\n".join(str(i) for i in range(4, 60000) if i % 2 == g and i % 7) for g in (0, 1)}
    got = grouped_string_agg(df, ["g"], "x", ["id"], "t").collect()
    assert {r.g: r.t for r in got} == want
    df.createOrReplaceTempView("texts")
    sql = spark.sql("SELECT g, newline_text(listagg(newline_item(x), '\\n') WITHIN GROUP (ORDER BY id)) AS t FROM texts GROUP BY g")
    assert {r.g: r.t for r in sql.collect()} == want and "Python" not in sql._jdf.queryExecution().executedPlan().toString()
    joined = spark.sql("SELECT newline_join(array('', NULL, 'a', '', 'b')), newline_join(array('')), newline_join(NULL)").first()
    assert tuple(joined) == ("a\n\nb", "", None)


@pytest.mark.parametrize("texts", [["", "", "a", "", "b", ""], ["", "\na", "\x01b", "\n\x01\x01", "c\x01"], ["", None, ""], [None], [], ["\x01", "\x01\x01\n"], ["$1\\", "\n"]])
def test_newline_aggregate_of_odd_texts(spark, texts):
    want = ""
    for x in texts:
        if x is not None:
            want = f"{want}\n{x}" if want else x
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, x string")
    rows.createOrReplaceTempView("odd_texts")
    assert spark.sql("SELECT newline_text(listagg(newline_item(x), '\\n') WITHIN GROUP (ORDER BY k)) FROM odd_texts").first()[0] == want


def test_sql_bins_and_whole_division(spark):
    row = spark.sql("SELECT int_div(-7, 2), cast(date_bin(INTERVAL '0 00:00:10' DAY TO SECOND, TIMESTAMP '2024-01-01 00:00:19.5') AS STRING)").first()
    assert tuple(row) == (-3, "2024-01-01 00:00:10")
