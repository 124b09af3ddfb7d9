"""Refused messages come again, until the handler takes them or a number of tries is used up.

`process_messages` handles a stream's messages once and keeps what the handler refused. `redeliver` reads those as a stream and keeps a table
of pending messages beside the checkpoint's own files: payload, tries so far, last error and the deadline of the next try. Every batch joins the new messages to
it by ack id, and those whose deadline has passed are handled, a handler call per message, in Arrow batches dealt over the shuffle
partitions; taken messages leave with their result, given up ones with their last error, the rest are the next batch's table.

The stream is run on what is there, again and again; each run ends by itself, so no batch is interrupted. Source positions are in the checkpoint, and a batch writes its table and its messages that leave under its own id, replacing what an
earlier run of the same batch wrote: a restart loses and doubles nothing. The tables of the last two batches are kept. A message delivered again while it is
pending is that message. Messages without an ack id cannot be acknowledged: they are handled and leave as `no_ack`, and only those already handled once come here.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.session import discard
from lakekit.streaming.messages import file_stream, run_available

# takes a payload and the number of this try; returns (result, error), where no error means taken
Retry = Callable[[bytes | None, int], tuple[str | None, str | None]]

MESSAGE = "ack_id STRING, payload BINARY, tries INT, error STRING, due BIGINT"
HANDLED = MESSAGE + ", result STRING, outcome STRING"
OUTCOME = "ack_id STRING, tries INT, result STRING, error STRING, outcome STRING"
PENDING = "pending"  # outcome of what stays
TICKS = "rate-micro-batch"  # a row for every run: without input Spark runs no batch, and nothing looks at a deadline


def retries_of(spark: SparkSession, out: str) -> DataFrame:
    """What `process_messages` has kept for redelivery, as a stream of (ack_id, payload)."""
    kept = file_stream(spark, out, "ack_id STRING, payload BINARY, batch_id BIGINT, outcome STRING", "*.parquet")
    return kept.where("outcome IN ('retry', 'no_ack')").select("ack_id", "payload")


def _deliver(handler: Retry, tries: int, deadline_ms: int, now: int):
    """Handle the messages that are due at `now`; the others stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ack, payload, done, error, due in zip(*(c.to_pylist() for c in batch.columns)):
                result, outcome = None, PENDING
                if due <= now:
                    result, error = handler(payload, done + 1)
                    done += 1
                    if ack is None:
                        outcome = "no_ack"
                    elif error is None:
                        outcome = "ok"
                    elif done >= tries:
                        result, outcome = None, "given_up"
                    else:
                        result, due = None, int(time.time() * 1000) + deadline_ms
                rows.append((ack, payload, done, error, due, result, outcome))
            columns = zip(*rows) if rows else [[]] * 7
            kinds = (pa.string(), pa.binary(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["ack_id", "payload", "tries", "error", "due", "result", "outcome"])

    return run


def redeliver(retries: DataFrame, handler: Retry, out: str, checkpoint: str, tries: int, deadline_ms: int = 1000, tried: int = 1,
              stop_after: int | None = None) -> None:
    """Deliver until every message is taken or given up after `tries` tries in all, of which `tried` came before; then stop.

    `stop_after` ends the run after so many batches even if messages are pending: the next run goes on where it stopped.
    """
    if tries <= tried:
        raise ValueError("no try is left")
    spark = retries.sparkSession
    spark.createDataFrame([], OUTCOME).write.mode("ignore").parquet(f"{out}/batch_id=-1")

    left: dict[int, int] = {}  # messages pending after each batch

    def table(batch_id: int) -> str:
        return f"{checkpoint}/pending/batch_id={batch_id}"

    spark.createDataFrame([], HANDLED).write.mode("ignore").parquet(table(-1))

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = batch.where("NOT tick").select("ack_id", "payload", F.lit(tried).alias("tries"), F.lit(None).cast("string").alias("error"), F.lit(0).cast("bigint").alias("due"))
        before = session.read.schema(HANDLED).parquet(table(batch_id - 1)).where(F.col("outcome") == PENDING).select(*fresh.columns)
        # of messages with one id the pending one counts
        known = before.withColumn("new", F.lit(0)).union(fresh.where("ack_id IS NOT NULL").withColumn("new", F.lit(1)))
        one = known.groupBy("ack_id").agg(F.min(F.struct("new", "payload", "tries", "error", "due")).alias("m")).select(
            "ack_id", "m.payload", "m.tries", "m.error", "m.due")
        due = one.union(fresh.where("ack_id IS NULL"))
        handled = due.mapInArrow(_deliver(handler, tries, deadline_ms, int(time.time() * 1000)), HANDLED)
        handled.write.mode("overwrite").parquet(table(batch_id))
        written = session.read.schema(HANDLED).parquet(table(batch_id))
        written.where(F.col("outcome") != PENDING).select("ack_id", "tries", "result", "error", "outcome").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        left[batch_id] = written.where(F.col("outcome") == PENDING).count()
        discard(session, table(batch_id - 2))  # a batch run again needs the table before it

    ticks = spark.readStream.format(TICKS).option("rowsPerBatch", 1).option("numPartitions", 1).load().select(
        F.lit(None).cast("string").alias("ack_id"), F.lit(None).cast("binary").alias("payload"), F.lit(True).alias("tick"))
    stream = retries.select("ack_id", "payload", F.lit(False).alias("tick")).union(ticks)
    while True:
        again = time.time() + max(deadline_ms, 100) / 1000
        query = run_available(stream, write, checkpoint)
        if _drained(query, left, stop_after):
            return
        time.sleep(max(again - time.time(), 0))


def _drained(query, left: dict[int, int], stop_after: int | None) -> bool:
    """Whether the last batch took no input and left no message pending."""
    last = query.lastProgress
    if last is None or last["batchId"] not in left:
        return False
    if stop_after is not None and last["batchId"] + 1 >= stop_after:
        return True
    taken = sum(s["numInputRows"] for s in last["sources"] if not s["description"].startswith("RatePerMicroBatch"))
    return taken == 0 and left[last["batchId"]] == 0


def delivered(spark: SparkSession, out: str) -> DataFrame:
    """(ack_id, tries, result, error, outcome) of all messages that have left."""
    return spark.read.schema(OUTCOME + ", batch_id BIGINT").parquet(out).drop("batch_id")
