"""At-least-once message handling with Structured Streaming.

A message is (ack_id, payload). Every micro-batch is handled once and written
under its own batch id, split by outcome, so a replayed batch replaces its
files instead of adding to them. The stream checkpoint is the acknowledgement:

  ok      handled and acknowledged, the result is kept
  empty   no payload: acknowledged, no result
  retry   the handler refused it: kept with its payload for redelivery
  no_ack  handled but without an ack id: no result, redelivered like a retry

A bad message therefore never holds up the rest of its batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakekit.operators.tables import all_nullable, validate_lines

# A handler turns a payload column into struct(value, error); a null error means success.
Handler = Callable[[Column], Column]


def file_stream(spark: SparkSession, folder: str, schema: T.StructType | str, glob: str,
                max_files: int | None = None) -> DataFrame:
    """Files of a folder as a stream; `max_files` bounds a micro-batch, which else takes all new files."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_messages: int) -> DataFrame:
    """A Kafka topic as (ack_id, payload); needs the Kafka connector on the class path."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("maxOffsetsPerTrigger", max_messages).load())
    position = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return raw.select(position.alias("ack_id"), F.col("value").alias("payload"))


def handle_messages(messages: DataFrame, handler: Handler) -> DataFrame:
    """(ack_id, payload, result, error, outcome) of a batch of messages."""
    empty = F.col("payload").isNull() | (F.octet_length("payload") == 0)
    handled = messages.withColumn("_h", F.when(~empty, handler(F.col("payload"))))
    return handled.select(
        "ack_id", "payload", F.col("_h.value").alias("result"), F.col("_h.error").alias("error"),
        F.when(empty, "empty").when(F.col("_h.error").isNotNull(), "retry")
        .when(F.col("ack_id").isNull(), "no_ack").otherwise("ok").alias("outcome"))


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, last: int | None = None) -> None:
    """Run a stream whose source bounds its batches until nothing new is there, or until batch number `last` is done."""
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
    try:
        if last is None:
            query.processAllAvailable()
        while last is not None and query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] < last):
            time.sleep(0.1)
    finally:
        failed = query.exception()
        query.stop()
    if failed is not None:
        raise failed


def _prepare(spark: SparkSession, out: str, column: str) -> None:
    """An empty first part, so an output no batch has reached yet reads as no rows."""
    spark.createDataFrame([], f"{column} STRING").write.mode("ignore").parquet(f"{out}/batch_id=-1/outcome=none")


def process_messages(messages: DataFrame, handler: Handler, out: str, checkpoint: str) -> None:
    """Handle everything available and stop; a second run on the same checkpoint adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (handle_messages(batch, handler).write.mode("overwrite").partitionBy("outcome")
         .parquet(f"{out}/batch_id={batch_id}"))

    _prepare(messages.sparkSession, out, "ack_id")
    run_available(messages, write, checkpoint)


def read_outcomes(spark: SparkSession, out: str, result_type: str = "STRING") -> DataFrame:
    schema = f"ack_id STRING, payload BINARY, result {result_type}, error STRING, batch_id BIGINT, outcome STRING"
    return spark.read.schema(schema).parquet(out)


def results(spark: SparkSession, out: str, result_type: str = "STRING") -> DataFrame:
    return read_outcomes(spark, out, result_type).where("outcome = 'ok'").select("ack_id", "result")


def dead_letters(spark: SparkSession, out: str) -> DataFrame:
    """Messages to deliver again, in the shape `handle_messages` takes."""
    return read_outcomes(spark, out).where("outcome IN ('retry', 'no_ack')").select("ack_id", "payload", "error")


def stream_insert(lines: DataFrame, line: str, schema: T.StructType, out: str, checkpoint: str,
                  ignore_unknown: bool = False) -> None:
    """Validated insert of a stream of JSON lines: valid rows and refused lines in two tables, batch by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = validate_lines(batch, line, schema, ignore_unknown).select(line, "row", "reason").withColumn(
            "outcome", F.when(F.col("reason").isNull(), "inserted").otherwise("refused"))
        checked.write.mode("overwrite").partitionBy("outcome").parquet(f"{out}/batch_id={batch_id}")

    _prepare(lines.sparkSession, out, line)
    run_available(lines, write, checkpoint)


def _insert_outcomes(spark: SparkSession, out: str, line: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([T.StructField(line, T.StringType()), T.StructField("row", all_nullable(schema)),
                           T.StructField("reason", T.StringType()), T.StructField("batch_id", T.LongType()),
                           T.StructField("outcome", T.StringType())])
    return spark.read.schema(stored).parquet(out)


def inserted_rows(spark: SparkSession, out: str, line: str, schema: T.StructType) -> DataFrame:
    return _insert_outcomes(spark, out, line, schema).where("outcome = 'inserted'").select("row.*")


def refused_lines(spark: SparkSession, out: str, line: str, schema: T.StructType) -> DataFrame:
    return _insert_outcomes(spark, out, line, schema).where("outcome = 'refused'").select(line, "reason")


def publish(df: DataFrame, topic: str, payload: Column, key: Column, path: str | None = None,
            servers: str | None = None) -> DataFrame:
    """Publish payload bytes to a topic, Kafka's or a folder's, and return the ids of these messages alone.

    Ids are topic and key, one per message, so the keys of a batch should be unique.
    """
    messages = df.select(F.concat(F.lit(topic + "/"), key.cast("string")).alias("message_id"),
                         key.cast("string").alias("key"), payload.cast("binary").alias("value"))
    if servers:
        (messages.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
        return messages.select("message_id")
    messages.write.mode("append").parquet(path)
    return messages.select("message_id")
