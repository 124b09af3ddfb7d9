"""Message streams run to completion over the stored events."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.plans.registry import query, table
from lakekit.session import scratch_path
from lakekit.streaming import messages, positions, redelivery

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _messages(spark, sf_dir):
    """Events as messages: errors carry no payload, cheap signups no ack id."""
    events = messages.file_stream(spark, sf_dir, EVENTS, "events.parquet")
    return events.select(
        F.when(~((F.col("event_type") == "signup") & (F.col("value") < 5)), F.col("event_id").cast("string")).alias("ack_id"),
        F.when(F.col("event_type") != "error", F.encode("props", "UTF-8")).alias("payload"))


def keep_small(payload):
    """The test handler: reads $.k and refuses values above 90."""
    k = F.get_json_object(payload.cast("string"), "$.k").try_cast("int")
    return F.struct(k.cast("string").alias("value"),
                    F.when(k.isNull(), "no k").when(k > 90, F.concat(F.lit("k too large: "), k)).alias("error"))


def _processed(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "messages"), scratch_path(spark, "messages-checkpoint")
    messages.process_messages(_messages(spark, sf_dir), keep_small, out, checkpoint)
    messages.process_messages(_messages(spark, sf_dir), keep_small, out, checkpoint)  # nothing new to do
    return out


K = "CAST(json_extract_string(props, '$.k') AS INT)"


@query("stream_process_messages", f"""
SELECT CAST(event_id AS VARCHAR) AS ack_id, CAST({K} AS VARCHAR) AS result FROM events
WHERE event_type <> 'error' AND {K} <= 90 AND NOT (event_type = 'signup' AND value < 5)
""")
def stream_process_messages(spark, sf_dir):
    return messages.results(spark, _processed(spark, sf_dir))


@query("stream_dead_letter", f"""
SELECT CASE WHEN NOT (event_type = 'signup' AND value < 5) THEN CAST(event_id AS VARCHAR) END AS ack_id, props AS payload,
       CASE WHEN {K} > 90 THEN 'k too large: ' || {K} END AS error FROM events
WHERE event_type <> 'error' AND ({K} > 90 OR (event_type = 'signup' AND value < 5))
""")
def stream_dead_letter(spark, sf_dir):
    return messages.dead_letters(spark, _processed(spark, sf_dir)).withColumn("payload", F.col("payload").cast("string"))


EVENT_LINE = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("value", T.DoubleType())])


def _event_lines(spark, sf_dir):
    """Events as JSON lines: views carry text for a number, clicks an extra key, errors no id."""
    key, value, kind = F.col("event_id"), F.col("value"), F.col("event_type")
    line = (F.when(kind == "view", F.to_json(F.struct("event_id", F.lit("n/a").alias("value"))))
            .when(kind == "click", F.to_json(F.struct("event_id", "value", "event_type")))
            .when(kind == "error", F.to_json(F.struct("value")))
            .otherwise(F.to_json(F.struct(key.alias("event_id"), value.alias("value")))))
    return messages.file_stream(spark, sf_dir, EVENTS, "events.parquet").select(line.alias("line"))


@query("stream_insert_validated", """
SELECT event_id, value, CAST(NULL AS VARCHAR) AS reason, CAST(1 AS BIGINT) AS n FROM events WHERE event_type IN ('purchase', 'signup')
UNION ALL
SELECT NULL, NULL, CASE event_type WHEN 'view' THEN 'wrong type' WHEN 'click' THEN 'unknown field' ELSE 'missing required' END, count(*)
FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY event_type
""")
def stream_insert_validated(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "inserted"), scratch_path(spark, "inserted-checkpoint")
    messages.stream_insert(_event_lines(spark, sf_dir), "line", EVENT_LINE, out, checkpoint)
    rows = messages.inserted_rows(spark, out, "line", EVENT_LINE).withColumns({"reason": F.lit(None).cast("string"), "n": F.lit(1).cast("long")})
    refused = messages.refused_lines(spark, out, "line", EVENT_LINE).groupBy("reason").agg(F.count("*").alias("n"))
    return rows.unionByName(refused, allowMissingColumns=True)


@query("publish_batch", """
SELECT 'events/' || event_id AS message_id, CAST(1 + event_id % 2 AS INT) AS batch, (SELECT count(*) FROM events) AS n_in_topic FROM events
""")
def publish_batch(spark, sf_dir):
    """Two publishes to one topic: each returns its own ids, the topic holds both."""
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "topic")
    sent = [messages.publish(events.where(f"event_id % 2 = {k}"), "events", F.encode("props", "UTF-8"), F.col("event_id"), path=path)
            .withColumn("batch", F.lit(k + 1)) for k in (0, 1)]
    held = spark.read.parquet(path).agg(F.count("*").alias("n_in_topic"))
    return sent[0].unionByName(sent[1]).join(F.broadcast(held))


def stubborn(payload, attempt):
    """The retry handler: takes $.k above 90 at try 2 + k % 3, what remains at once."""
    k = json.loads(payload)["k"]
    return (str(k), None) if attempt >= 2 + (k % 3 if k > 90 else 0) else (None, f"k {k} refused at try {attempt}")


NEED = f"(2 + CASE WHEN {K} > 90 THEN {K} % 3 ELSE 0 END)"


@query("stream_redelivery", f"""
SELECT CASE WHEN NOT (event_type = 'signup' AND value < 5) THEN CAST(event_id AS VARCHAR) END AS ack_id,
       CASE WHEN event_type = 'signup' AND value < 5 THEN 2 ELSE least({NEED}, 3) END AS tries,
       CASE WHEN event_type = 'signup' AND value < 5 THEN CASE WHEN {NEED} = 2 THEN CAST({K} AS VARCHAR) END
            WHEN {NEED} <= 3 THEN CAST({K} AS VARCHAR) END AS result,
       CASE WHEN event_type = 'signup' AND value < 5 THEN CASE WHEN {NEED} > 2 THEN 'k ' || {K} || ' refused at try 2' END
            WHEN {NEED} > 3 THEN 'k ' || {K} || ' refused at try 3' END AS error,
       CASE WHEN event_type = 'signup' AND value < 5 THEN 'no_ack' WHEN {NEED} <= 3 THEN 'ok' ELSE 'given_up' END AS outcome
FROM events WHERE event_type <> 'error' AND ({K} > 90 OR (event_type = 'signup' AND value < 5))
""")
def stream_redelivery(spark, sf_dir):
    """What the first handling refused comes again, three tries in all; the stream is stopped after its first batch and started again."""
    refused = redelivery.retries_of(spark, _processed(spark, sf_dir))
    out, checkpoint = scratch_path(spark, "redelivered"), scratch_path(spark, "redelivered-checkpoint")
    redelivery.redeliver(refused, stubborn, out, checkpoint, tries=3, deadline_ms=100, stop_after=1)
    redelivery.redeliver(refused, stubborn, out, checkpoint, tries=3, deadline_ms=100)
    return redelivery.delivered(spark, out)


@query("stream_message_bound", """
SELECT event_id, event_type, value, ceil(count(*) OVER () / ((count(*) OVER () + 6) // 7))::BIGINT AS n_batches, true AS bounded FROM events
""")
def stream_message_bound(spark, sf_dir):
    """Three files in batches of at most a seventh of all rows; the second run starts in the middle of a file."""
    folder, out, checkpoint = scratch_path(spark, "bounded"), scratch_path(spark, "bounded-out"), scratch_path(spark, "bounded-checkpoint")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    events.repartition(3, "event_id").write.parquet(folder)
    bound = (events.count() + 6) // 7
    for last in (1, None):
        stream = positions.position_stream(spark, folder, events.schema, bound, checkpoint)
        messages.run_batches(stream, lambda batch, k: batch.write.mode("overwrite").parquet(f"{out}/batch_id={k}"), checkpoint, last)
    rows = spark.read.schema("event_id BIGINT, event_type STRING, value DOUBLE, batch_id BIGINT").parquet(out)
    sizes = rows.groupBy("batch_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("n_batches"), (F.max("n") <= bound).alias("bounded"))
    return rows.drop("batch_id").join(F.broadcast(sizes))
