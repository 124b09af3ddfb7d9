import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.session import scratch_path
from lakekit.streaming import messages, positions, redelivery


def handler(payload):
    text = payload.cast("string")
    return F.struct(F.upper(text).alias("value"), F.when(text.startswith("bad"), "refused").alias("error"))


ROWS = [("1", b"good"), ("2", b"bad"), ("3", b""), ("4", None), (None, b"orphan")]


def put(spark, folder, rows):
    spark.createDataFrame(rows, "ack_id string, payload binary").coalesce(1).write.mode("append").parquet(folder)


def test_outcomes(spark):
    df = messages.handle_messages(spark.createDataFrame(ROWS, "ack_id string, payload binary"), handler)
    assert [(r.ack_id, r.outcome) for r in df.collect()] == [
        ("1", "ok"), ("2", "retry"), ("3", "empty"), ("4", "empty"), (None, "no_ack")]


def test_stream_resumes_and_never_doubles(spark):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    put(spark, source, ROWS)

    def run():
        stream = messages.file_stream(spark, source, "ack_id string, payload binary", "*.parquet")
        messages.process_messages(stream, handler, out, checkpoint)

    run()
    run()
    assert [tuple(r) for r in messages.results(spark, out).collect()] == [("1", "GOOD")]
    dead = messages.dead_letters(spark, out)
    assert sorted(bytes(r.payload) for r in dead.collect()) == [b"bad", b"orphan"]
    put(spark, source, [("9", b"late")])
    run()
    assert sorted(r.result for r in messages.results(spark, out).collect()) == ["GOOD", "LATE"]
    # dead letters have the shape of messages, so they can be handled again
    again = messages.handle_messages(dead, lambda p: F.struct(p.cast("string").alias("value"), F.lit(None).cast("string").alias("error")))
    assert {r.outcome for r in again.collect()} == {"ok", "no_ack"}


def test_a_replayed_batch_replaces_its_files(spark):
    out = scratch_path(spark, "out")
    batch = messages.handle_messages(spark.createDataFrame(ROWS, "ack_id string, payload binary"), handler)
    for _ in range(2):
        batch.write.mode("overwrite").partitionBy("outcome").parquet(f"{out}/batch_id=0")
    assert messages.results(spark, out).count() == 1


def test_publish_returns_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = scratch_path(spark, "topic")
    ids = messages.publish(df, "t", F.col("v"), F.col("k"), path=path)
    assert sorted(r.message_id for r in ids.collect()) == ["t/1", "t/2"]
    assert spark.read.parquet(path).schema["value"].dataType == T.BinaryType()


def test_a_stream_without_messages_reads_as_empty(spark):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    put(spark, source, [])
    stream = messages.file_stream(spark, source, "ack_id string, payload binary", "*.parquet")
    messages.process_messages(stream.where("ack_id = 'none'"), handler, out, checkpoint)
    assert messages.results(spark, out).count() == 0 and messages.dead_letters(spark, out).count() == 0


def test_a_replayed_insert_batch_never_doubles(spark):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    schema = T.StructType([T.StructField("id", T.LongType(), False)])
    spark.createDataFrame([('{"id": 1}',), ('{"id": "x"}',), ('{"id": 2, "k": 1}',)], "line string").write.parquet(source)
    for _ in range(2):
        stream = messages.file_stream(spark, source, "line string", "*.parquet", max_files=10)
        messages.stream_insert(stream, "line", schema, out, checkpoint)
    assert [r.id for r in messages.inserted_rows(spark, out, "line", schema).collect()] == [1]
    assert sorted(r.reason for r in messages.refused_lines(spark, out, "line", schema).collect()) == ["unknown field", "wrong type"]


def test_refused_messages_come_again(spark):
    def patient(payload, attempt):
        """Takes `n...` at try n."""
        return (payload[1:].decode(), None) if attempt >= int(payload[:1]) else (None, f"not at {attempt}")

    source, out, checkpoint = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    put(spark, source, [("a", b"2x"), ("b", b"4y"), ("c", b"9z"), (None, b"2orphan"), (None, b"2orphan"), ("a", b"2x")])

    def run(stop_after=None):
        stream = messages.file_stream(spark, source, "ack_id string, payload binary", "*.parquet")
        redelivery.redeliver(stream, patient, out, checkpoint, tries=5, deadline_ms=100, stop_after=stop_after)

    run(stop_after=1)  # b and c are pending now
    run(stop_after=2)
    run()
    want = {("a", 2, "x", None, "ok"), ("b", 4, "y", None, "ok"), ("c", 5, None, "not at 5", "given_up"), (None, 2, "orphan", None, "no_ack")}
    first = [tuple(r) for r in redelivery.delivered(spark, out).collect()]
    assert set(first) == want and len([r for r in first if r[0] != "a"]) == 4
    put(spark, source, [("d", b"3w")])
    run()
    run()  # nothing new to do
    again = [tuple(r) for r in redelivery.delivered(spark, out).collect()]
    assert sorted(map(repr, again)) == sorted(map(repr, first + [("d", 3, "w", None, "ok")]))
    with pytest.raises(ValueError):
        redelivery.redeliver(spark.readStream.format("rate").load(), patient, out, checkpoint, tries=1)


def test_many_messages_are_handled_by_the_batch(spark):
    """A batch of messages goes through one Python call, not one group with tables of its own per message and try; few tables of pending ones are kept."""
    batch = pa.RecordBatch.from_pylist([{"ack_id": a, "payload": b"x", "tries": 1, "error": None, "due": d} for a, d in (("a", 0), ("b", 9), (None, 0))])
    run = redelivery._deliver(lambda p, n: (p.decode(), "no" if n < 3 else None), 3, 50, 5)
    assert [tuple(r.values())[i] for r in next(run(iter([batch]))).to_pylist() for i in (0, 2, 6)] == ["a", 2, "pending", "b", 1, "pending", None, 2, "no_ack"]
    source, out, checkpoint = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    spark.range(20_000).selectExpr("string(id) AS ack_id", "encode(string(id), 'UTF-8') AS payload").write.parquet(source)
    stream = messages.file_stream(spark, source, "ack_id string, payload binary", "*.parquet")
    redelivery.redeliver(stream, lambda p, n: (p.decode(), None if n > int(p) % 5 else "no"), out, checkpoint, tries=4, deadline_ms=100)
    got = redelivery.delivered(spark, out).groupBy("outcome", "tries").count().collect()
    assert {tuple(r) for r in got} == {("ok", 2, 8000), ("ok", 3, 4000), ("ok", 4, 4000), ("given_up", 4, 4000)}
    assert len(os.listdir(f"{checkpoint}/pending")) == 2


def test_redelivery_of_what_a_stream_refused(spark):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    put(spark, source, ROWS + [("5", b"bad too")])
    stream = messages.file_stream(spark, source, "ack_id string, payload binary", "*.parquet")
    messages.process_messages(stream, handler, out, checkpoint)
    again, state = scratch_path(spark, "again"), scratch_path(spark, "again-ckpt")
    redelivery.redeliver(redelivery.retries_of(spark, out), lambda p, n: (p.decode(), None if n > 2 else "no"), again, state, tries=4, deadline_ms=100)
    assert {(r.ack_id, r.tries, r.outcome) for r in redelivery.delivered(spark, again).collect()} == {("2", 3, "ok"), ("5", 3, "ok"), (None, 2, "no_ack")}


def test_batches_hold_a_bounded_number_of_messages(spark):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    schema = "k long, at timestamp, tags array<string>"

    def add(low, high):
        rows = spark.range(low, high).select(F.col("id").alias("k"), F.timestamp_seconds("id").alias("at"), F.array(F.col("id").cast("string")).alias("tags"))
        rows.coalesce(1).write.mode("append").option("parquet.block.size", "2000").option("parquet.page.row.count.limit", "100").parquet(source)

    def run(bound, last=None):
        stream = positions.position_stream(spark, source, schema, bound, checkpoint)
        messages.run_batches(stream, lambda batch, k: batch.write.mode("overwrite").parquet(f"{out}/batch_id={k}"), checkpoint, last)

    def batches():
        rows = spark.read.parquet(out).collect()
        assert all(r["at"].timestamp() == r.k and r.tags == [str(r.k)] for r in rows)
        sizes = {}
        for r in rows:
            sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
        assert len({r.k for r in rows}) == len(rows)
        return [sizes[k] for k in sorted(sizes)]

    add(0, 1000)
    add(1000, 1030)
    run(300, last=1)  # ends in the middle of the first file
    assert batches()[:2] == [300, 300] and set(batches()) <= {300, 130}
    run(300)
    assert batches() == [300, 300, 300, 130]
    run(7)  # nothing new
    assert batches() == [300, 300, 300, 130]
    add(2000, 2010)
    run(4)
    assert batches() == [300, 300, 300, 130, 4, 4, 2]
    with pytest.raises(ValueError):
        positions.position_stream(spark, source, schema, 0, checkpoint)
