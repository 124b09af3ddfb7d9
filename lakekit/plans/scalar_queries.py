"""Scalar functions, resource records, model requests and responses, text and map series."""

from pyspark.sql import functions as F

from lakekit.functions import fixed_values as fixed
from lakekit.functions import scalars
from lakekit.operators import features, resources, responses, series, text
from lakekit.plans.registry import query, table


@query("pow_f64", """
SELECT l_orderkey, l_partkey, round(pow(nullif(l_quantity, 3), l_discount), 6) AS p,
       pow(l_linenumber, 2) AS square, pow(1, nullif(l_tax, 0)) AS one
FROM lineitem
""")
def pow_f64(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.round(scalars.cpow(F.nullif("l_quantity", F.lit(3.0)), F.col("l_discount")), 6).alias("p"),
        scalars.cpow(F.col("l_linenumber").cast("double"), F.lit(2.0)).alias("square"),
        scalars.cpow(F.lit(1.0), F.nullif("l_tax", F.lit(0.0))).alias("one"))


# Names built from orders; orders of one status are malformed on purpose.
NAMES = """SELECT o_orderkey, 'projects/p' || o_custkey || '/locations/' || lower(substr(o_orderpriority, 3)) AS parent,
  o_orderstatus AS st FROM orders"""


def _names(spark, sf_dir):
    parent = scalars.location_path(F.concat(F.lit("p"), "o_custkey"), F.lower(F.expr("substr(o_orderpriority, 3)")))
    return table(spark, sf_dir, "orders").select("o_orderkey", parent.alias("parent"), F.col("o_orderstatus").alias("st"))


@query("resource_name_parse", f"""
WITH n AS (SELECT o_orderkey, CASE st WHEN 'F' THEN parent || '/jobs/j/jobs/x' || o_orderkey || '/executions/e' || o_orderkey
                  WHEN 'O' THEN parent || '/jobs/j' || o_orderkey ELSE parent || '/services' END AS name FROM ({NAMES})),
 e AS (SELECT *, regexp_matches(name, 'projects/.+/locations/.+/jobs/.+/executions/.+') AS ok,
              regexp_matches(name, 'projects/.+/locations/.+/jobs/.+') AS job_ok FROM n)
SELECT o_orderkey, ok AS execution_ok, job_ok,
  CASE WHEN ok THEN regexp_extract(name, 'projects/(.+)/locations/(.+)/jobs/(.+)/executions/(.+)', 1) END AS project,
  CASE WHEN ok THEN regexp_extract(name, 'projects/(.+)/locations/(.+)/jobs/(.+)/executions/(.+)', 3) END AS job_name,
  CASE WHEN ok THEN regexp_extract(name, 'projects/(.+)/locations/(.+)/jobs/(.+)/executions/(.+)', 4) END AS execution_name,
  CASE WHEN job_ok THEN regexp_extract(name, 'projects/(.+)/locations/(.+)/jobs/(.+)', 3) END AS job_tail
FROM e
""")
def resource_name_parse(spark, sf_dir):
    key = F.col("o_orderkey")
    name = (F.when(F.col("st") == "F", F.concat("parent", F.lit("/jobs/j/jobs/x"), key, F.lit("/executions/e"), key))
            .when(F.col("st") == "O", F.concat("parent", F.lit("/jobs/j"), key))
            .otherwise(F.concat("parent", F.lit("/services"))))
    parsed = _names(spark, sf_dir).select(
        "o_orderkey", scalars.parse_resource_name(name, "execution").alias("e"),
        scalars.parse_resource_name(name, "job").alias("j"))
    return parsed.select("o_orderkey", F.col("e.is_valid").alias("execution_ok"), F.col("j.is_valid").alias("job_ok"),
                         "e.project", "e.job_name", "e.execution_name", F.col("j.job_name").alias("job_tail"))


@query("resource_name_format", f"""
SELECT o_orderkey, parent, parent || '/services/s' || o_orderkey AS service, parent || '/jobs/j' || o_orderkey AS job,
       parent || '/jobs/j' || o_orderkey || '/executions/' || st AS execution
FROM ({NAMES})
""")
def resource_name_format(spark, sf_dir):
    project = F.concat(F.lit("p"), "o_custkey")
    location = F.lower(F.expr("substr(o_orderpriority, 3)"))
    job = F.concat(F.lit("j"), "o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", scalars.location_path(project, location).alias("parent"),
        scalars.service_name(project, location, F.concat(F.lit("s"), "o_orderkey")).alias("service"),
        scalars.job_name(project, location, job).alias("job"),
        scalars.execution_name(project, location, job, F.col("o_orderstatus")).alias("execution"))


@query("status_map", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'Running' ELSE 'Unknown' END AS status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Started' WHEN '2-HIGH' THEN 'Retry' ELSE 'Undefined' END AS condition_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Succeeded' WHEN '2-HIGH' THEN 'Failed' ELSE 'Unspecified' END AS condition_state
FROM orders
""")
def status_map(spark, sf_dir):
    status = scalars.lookup(F.col("o_orderstatus"), {"F": "DONE", "O": "RUNNING"}, "running")
    kind = scalars.lookup(F.col("o_orderpriority"), {"1-URGENT": "Started", "2-HIGH": "Retry"}, "Other")
    state = scalars.lookup(F.col("o_orderpriority"), {"1-URGENT": "CONDITION_SUCCEEDED", "2-HIGH": "CONDITION_FAILED"})
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", scalars.job_status(status).alias("status"),
        scalars.condition_type(kind).alias("condition_type"), scalars.condition_state(state).alias("condition_state"))


@query("error_classify", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'NotFound' WHEN 'view' THEN 'Forbidden' ELSE 'Undefined' END AS kind,
  CASE event_type WHEN 'error' THEN 404 WHEN 'view' THEN 403 WHEN 'click' THEN 409 ELSE 500 END AS code,
  CASE WHEN event_type IN ('error', 'click', 'signup') THEN 'user ' || user_id ELSE 'Unknown error' END AS message
FROM events
""")
def error_classify(spark, sf_dir):
    """An error log derived from events: coded, without message, without code, without error."""
    kind, message = F.col("event_type"), F.concat(F.lit("user "), "user_id")
    code = scalars.lookup(kind, {"error": 404, "view": 403, "click": 409})
    body = F.when(kind == "purchase", F.lit('{"status": "odd"}')).otherwise(F.to_json(F.struct(F.struct(
        code.alias("code"), F.when(kind != "view", message).alias("message")).alias("error"))))
    return table(spark, sf_dir, "events").select("event_id", scalars.classify_error(body).alias("e")).select("event_id", "e.*")


MODELS = """CASE role WHEN 'user' THEN 'gemini-1.5-pro' WHEN 'assistant' THEN 'claude-3-haiku' ELSE 'text-embedding-005' END"""


@query("model_route", f"""
SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 'anthropic' ELSE 'google' END AS publisher,
  'projects/c' || conv_id || '/locations/us/publishers/' || CASE role WHEN 'assistant' THEN 'anthropic' ELSE 'google' END
  || '/models/' || {MODELS} AS model_path
FROM conversations
""")
def model_route(spark, sf_dir):
    model = F.expr(MODELS)
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", scalars.model_publisher(model).alias("publisher"),
        scalars.model_path(F.concat(F.lit("c"), "conv_id"), F.lit("us"), model).alias("model_path"))


@query("topic_path", """
SELECT event_id, 'projects/u' || user_id || '/topics/' || event_type AS topic,
       'projects/u' || user_id || '/subscriptions/' || event_type || '-sub' AS subscription FROM events
""")
def topic_path(spark, sf_dir):
    project = F.concat(F.lit("u"), "user_id")
    return table(spark, sf_dir, "events").select(
        "event_id", scalars.topic_path(project, F.col("event_type")).alias("topic"),
        scalars.subscription_path(project, F.concat("event_type", F.lit("-sub"))).alias("subscription"))


# ---------------------------------------------------------------- run resources
# Job, service and execution JSON written out of supplier columns.

def _resource_json(spark, sf_dir, kind):
    key = F.col("s_suppkey").cast("string")

    def container(n, *more):
        return F.struct(F.concat(F.lit(f"img{n}:"), key).alias("image"), *more)

    env = F.array(F.struct(F.lit("A").alias("name"), F.col("s_name").alias("value")),
                  F.struct(F.lit("B").alias("name"), F.lit(None).cast("string").alias("value")),
                  F.struct(F.lit("A").alias("name"), key.alias("value")))
    boxes = F.array(
        container(1, F.array(F.lit("--n"), key).alias("args"), env.alias("env"),
                  F.struct(F.create_map(F.lit("cpu"), F.lit("1")).alias("limits")).alias("resources")),
        container(2, F.lit(None).cast("array<string>").alias("args"),
                  F.lit(None).cast("array<struct<name:string,value:string>>").alias("env"),
                  F.lit(None).cast("struct<limits:map<string,string>>").alias("resources")))
    vols = F.array(F.struct(F.lit("v").alias("name"), F.struct(
        F.when(F.col("s_acctbal") > 0, F.array(F.concat(F.lit("db"), key))).otherwise(F.array().cast("array<string>"))
        .alias("instances")).alias("cloudSqlInstance")))
    task = F.struct(F.concat("s_nationkey", F.lit("s")).alias("timeout"), F.lit("sa@x").alias("serviceAccount"),
                    boxes.alias("containers"), vols.alias("volumes"), F.lit(3).alias("maxRetries"),
                    F.struct(F.lit(9).alias("maxInstanceCount")).alias("scaling"))
    name = scalars.location_path(F.concat(F.lit("p"), "s_nationkey"), F.lit("us"))
    if kind == "job":
        body = F.struct(scalars.job_name(F.concat(F.lit("p"), "s_nationkey"), F.lit("us"), key).alias("name"),
                        F.create_map(F.lit("k"), F.col("s_name")).alias("labels"),
                        F.struct(F.lit(2).alias("taskCount"),
                                 F.when(F.col("s_nationkey") != 7, task).alias("template")).alias("template"))
    elif kind == "service":
        body = F.struct(F.concat(name, F.lit("/services/"), key).alias("name"), F.lit("https://x").alias("uri"),
                        F.when(F.col("s_nationkey") != 7, task).alias("template"))
    else:
        body = F.struct(F.concat(name, F.lit("/jobs/j/executions/"), key).alias("name"),
                        F.col("s_suppkey").alias("generation"), F.lit("2024-01-02T03:04:05Z").alias("startTime"),
                        F.array(F.struct(F.lit("Completed").alias("type"), F.lit("CONDITION_FAILED").alias("state")),
                                F.struct(F.lit("Odd").alias("type"), F.lit("Odd").alias("state"))).alias("conditions"),
                        F.when(F.col("s_nationkey") != 7, task).alias("template"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.to_json(body).alias("body"))


@query("run_resources_flatten", """
WITH k(kind) AS (VALUES ('job'), ('service'), ('execution')), c(image) AS (VALUES ('img1:'), ('img2:'))
SELECT kind, s_suppkey, 'p' || s_nationkey AS project, CAST(s_suppkey AS VARCHAR) AS own_name,
  CASE WHEN s_nationkey <> 7 THEN CAST(s_nationkey AS BIGINT) END AS timeout,
  CASE WHEN s_nationkey <> 7 THEN image || s_suppkey END AS image,
  CASE WHEN s_nationkey <> 7 THEN CASE image WHEN 'img1:' THEN '--n,' || s_suppkey ELSE '' END END AS args,
  CASE kind WHEN 'job' THEN s_name WHEN 'service' THEN CASE WHEN s_nationkey <> 7 THEN '9' END
            ELSE 'Completed=Failed,Undefined=Unspecified' END AS extra,
  CASE WHEN s_nationkey <> 7 AND s_acctbal > 0 AND kind <> 'execution' THEN 'db' || s_suppkey END AS instance,
  CASE WHEN s_nationkey = 7 THEN CASE kind WHEN 'job' THEN 'task template does not exist'
       ELSE 'template does not exist' END END AS error
FROM supplier, k, c WHERE s_nationkey <> 7 OR image = 'img1:'
""")
def run_resources_flatten(spark, sf_dir):
    """Jobs, services and executions flattened, one row per container."""
    jobs = resources.flatten_jobs(_resource_json(spark, sf_dir, "job"), "body", ["s_suppkey"]).select(
        F.lit("job").alias("kind"), "*", F.col("labels")["k"].alias("extra"), F.col("name.job_name").alias("own_name"))
    services = resources.flatten_services(_resource_json(spark, sf_dir, "service"), "body", ["s_suppkey"]).select(
        F.lit("service").alias("kind"), "*", F.col("max_instance_count").cast("string").alias("extra"),
        F.col("name.service_name").alias("own_name"))
    executions = resources.flatten_executions(_resource_json(spark, sf_dir, "execution"), "body", ["s_suppkey"]).select(
        F.lit("execution").alias("kind"), "*",
        F.array_join(F.transform("conditions", lambda c: F.concat(c["type"], F.lit("="), c["state"])), ",").alias("extra"),
        F.col("name.execution_name").alias("own_name"),
        F.array().cast("array<struct<name:string,cloud_sql_instance:string>>").alias("volumes"))
    out = None
    for flat in (jobs, services, executions):
        rows = flat.select("kind", "s_suppkey", F.col("name.project").alias("project"), "own_name", "timeout", "extra",
                           F.get("volumes", F.lit(0))["cloud_sql_instance"].alias("instance"), "error",
                           F.explode_outer("containers").alias("c"))
        rows = rows.select("kind", "s_suppkey", "project", "own_name", "timeout", "extra", "instance", "error",
                           F.col("c.image").alias("image"), F.array_join("c.args", ",").alias("args"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("env_to_map", """
SELECT s_suppkey, k AS name, CASE k WHEN 'A' THEN CAST(s_suppkey AS VARCHAR) ELSE '' END AS value
FROM supplier, (VALUES ('A'), ('B')) AS t(k) WHERE s_nationkey <> 7
""")
def env_to_map(spark, sf_dir):
    flat = resources.flatten_jobs(_resource_json(spark, sf_dir, "job"), "body", ["s_suppkey"])
    return resources.container_rows(flat, "s_suppkey").select("s_suppkey", F.explode("env").alias("name", "value"))


# ---------------------------------------------------------------- model requests and responses

@query("llm_request_build", """
SELECT conv_id, turn, '{"contents":[{"role":"user","parts":[' || to_json({'text': text}) ||
  CASE WHEN role = 'user' THEN ',{"fileData":{"fileUri":"gs://b/' || conv_id || '.pdf","mimeType":"application/pdf"}}' ELSE '' END ||
  CASE WHEN role = 'system' THEN ',{"inlineData":{"data":"' || base64(encode(text)) || '","mimeType":"text/plain"}}' ELSE '' END
  || ']}]}' AS request
FROM conversations
""")
def llm_request_build(spark, sf_dir):
    role = F.col("role")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", responses.content_request(
        responses.text_part(F.col("text")),
        F.when(role == "user", responses.file_part(F.concat(F.lit("gs://b/"), "conv_id", F.lit(".pdf")))),
        F.when(role == "system", responses.inline_part(F.encode("text", "UTF-8"), F.lit("text/plain")))).alias("request"))


@query("embed_request_build", """
SELECT doc_id, '{"instances":[' || to_json({'content': text, 'task_type': CASE lang WHEN 'en' THEN 'RETRIEVAL_DOCUMENT'
       WHEN 'fr' THEN 'CLUSTERING' END}) || ']}' AS request FROM documents
""")
def embed_request_build(spark, sf_dir):
    task = scalars.lookup(F.col("lang"), {"en": "RETRIEVAL_DOCUMENT", "fr": "CLUSTERING"})
    return table(spark, sf_dir, "documents").select("doc_id", responses.embed_request(F.col("text"), task).alias("request"))


def _content_responses(spark, sf_dir):
    """Response bodies from conversations: with text, without parts, without candidates."""
    role, n = F.col("role"), F.length("text")
    parts = F.when(role != "assistant", F.array(F.struct(F.col("text").alias("text")), F.struct(F.lit("x").alias("text"))))
    body = F.struct(
        F.when(role != "system", F.array(F.struct(F.struct(parts.alias("parts")).alias("content")))).alias("candidates"),
        F.struct(n.alias("promptTokenCount"), F.when(role == "user", F.lit(7)).alias("candidatesTokenCount"),
                 (n + 7).alias("totalTokenCount")).alias("usageMetadata"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.expr(MODELS).alias("model"), F.to_json(body).alias("body"))


@query("llm_response_decode", f"""
SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS text, CASE WHEN role = 'user' THEN 'Text' ELSE 'None' END AS result,
  {MODELS} AS model_name, CAST(length(text) AS INT) AS prompt_tokens, CASE WHEN role = 'user' THEN 7 END AS completion_tokens,
  CAST(length(text) + 7 AS INT) AS total_tokens
FROM conversations
""")
def llm_response_decode(spark, sf_dir):
    decoded = responses.decode_content(_content_responses(spark, sf_dir), "body", "model", ["conv_id", "turn"])
    return decoded.select("conv_id", "turn", "text", "result", "token_info.*")


@query("embedding_response_decode", """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total,
  CAST(len(embedding) AS BIGINT) AS n, CAST(label AS INT) AS prompt_tokens, 0 AS completion_tokens,
  CAST(NULL AS VARCHAR) AS error FROM embeddings WHERE label <> 3
UNION ALL SELECT vec_id, NULL, NULL, NULL, NULL, 'no predictions' FROM embeddings WHERE label = 3
""")
def embedding_response_decode(spark, sf_dir):
    """Vectors in response form and back; one label's responses carry no prediction."""
    body = F.when(F.col("label") == 3, F.lit("{}")).otherwise(F.to_json(F.struct(F.array(F.struct(F.struct(
        F.struct(F.col("label").alias("token_count"), F.lit(False).alias("truncated")).alias("statistics"),
        F.col("embedding").alias("values")).alias("embeddings"))).alias("predictions"))))
    bodies = table(spark, sf_dir, "embeddings").select("vec_id", F.lit("text-embedding-005").alias("model"), body.alias("body"))
    decoded = responses.decode_embeddings(bodies, "body", "model", ["vec_id"])
    total = F.aggregate("embeddings", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return decoded.select("vec_id", F.round(total, 4).alias("total"),
                          F.when(F.col("embeddings").isNotNull(), F.size("embeddings")).cast("long").alias("n"),
                          "token_info.prompt_tokens", "token_info.completion_tokens", "error")


@query("token_usage", f"""
SELECT {MODELS} AS model_name, count(*) AS calls, CAST(sum(length(text)) AS BIGINT) AS prompt_tokens,
  CAST(sum(CASE WHEN role = 'user' THEN 7 END) AS BIGINT) AS completion_tokens,
  CAST(sum(length(text) + 7) AS BIGINT) AS total_tokens
FROM conversations GROUP BY 1
""")
def token_usage(spark, sf_dir):
    return responses.token_usage(responses.decode_content(_content_responses(spark, sf_dir), "body", "model"))


# ---------------------------------------------------------------- text

@query("tokenize_documents", r"""
SELECT doc_id, pos - 1 AS pos, token FROM (
  SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS w FROM documents))
""")
def tokenize_documents(spark, sf_dir):
    tokens = text.tokenize(table(spark, sf_dir, "documents"), "doc_id", "text")
    return tokens.select("doc_id", F.col("pos").cast("long").alias("pos"), "token")


@query("token_counts", r"""
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS token FROM documents) GROUP BY token
""")
def token_counts(spark, sf_dir):
    return text.token_counts(text.tokenize(table(spark, sf_dir, "documents"), "doc_id", "text"))


# ---------------------------------------------------------------- features and map series

@query("project_dynamic", "SELECT l_quantity, l_discount, l_returnflag FROM lineitem")
def project_dynamic(spark, sf_dir):
    return features.project(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], None, "l_returnflag")


@query("features_numeric", "SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(l_partkey AS DOUBLE) AS l_partkey, l_tax FROM lineitem")
def features_numeric(spark, sf_dir):
    return features.features(table(spark, sf_dir, "lineitem"), ["l_linenumber", "l_partkey", "l_tax"])


@query("distinct_features", "SELECT DISTINCT l_quantity, l_discount FROM lineitem")
def distinct_features(spark, sf_dir):
    return features.distinct_features(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"])


@query("label_join_back", """
WITH t AS (SELECT l_quantity, l_discount, dense_rank() OVER (ORDER BY l_quantity, l_discount) - 1 AS label
           FROM (SELECT DISTINCT l_quantity, l_discount FROM lineitem))
SELECT l.l_orderkey, l.l_partkey, l.l_quantity, l.l_discount, label FROM lineitem l JOIN t USING (l_quantity, l_discount)
""")
def label_join_back(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount")
    columns = ["l_quantity", "l_discount"]
    labels = features.with_rank(features.distinct_features(lineitem, columns), columns, "label")
    return features.label_join_back(lineitem, labels, columns)


def _map_points(spark, sf_dir):
    places = table(spark, sf_dir, "embeddings").select(
        (F.col("embedding")[0].cast("double") * 180).alias("lon"), (F.col("embedding")[1].cast("double") * 90).alias("lat"),
        F.nullif(F.concat(F.lit("v"), F.col("vec_id") % 9), F.lit("v4")).alias("tag"), F.nullif("label", F.lit(0)).alias("grp"))
    return series.map_points(places, "lon", "lat", "tag", "grp")


POINTS = """(SELECT CAST(embedding[1] AS DOUBLE) * 180 AS lon, CAST(embedding[2] AS DOUBLE) * 90 AS lat,
  CASE WHEN vec_id % 9 = 4 THEN '' ELSE 'v' || vec_id % 9 END AS label, coalesce(CAST(nullif(label, 0) AS VARCHAR), '') AS series
  FROM embeddings)"""


@query("distinct_legends", "SELECT DISTINCT label FROM embeddings")
def distinct_legends(spark, sf_dir):
    return series.distinct_legends(table(spark, sf_dir, "embeddings"), "label")


@query("map_series", f"""
SELECT series, count(*) AS n, round(avg(lon), 6) AS avg_lon, round(min(lon), 6) AS min_lon, round(max(lon), 6) AS max_lon,
  round(avg(lat), 6) AS avg_lat, round(min(lat), 6) AS min_lat, round(max(lat), 6) AS max_lat,
  count(CASE WHEN label <> '' THEN 1 END) AS n_labels
FROM {POINTS} GROUP BY series
""")
def map_series(spark, sf_dir):
    stats = series.series_stats(_map_points(spark, sf_dir))
    return stats.select("series", "n", "n_labels", *[F.round(f"{f}_{c}", 6).alias(f"{f}_{c}")
                                                     for c in ("lon", "lat") for f in ("avg", "min", "max")])


@query("map_points", f"SELECT series, round(lon, 6) AS lon, round(lat, 6) AS lat, label FROM {POINTS}")
def map_points(spark, sf_dir):
    return _map_points(spark, sf_dir).select("series", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "label")


@query("map_center", f"""
SELECT round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat, count(*) AS n_series
FROM (SELECT series, avg(lon) AS lon, avg(lat) AS lat FROM {POINTS} GROUP BY series)
""")
def map_center(spark, sf_dir):
    return series.map_center(_map_points(spark, sf_dir)).select(
        F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "n_series")
