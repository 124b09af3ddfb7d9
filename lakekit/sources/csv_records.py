"""CSV files cut into records inside one file, so that a large file with line breaks in quotes is many tasks.

Whether a line feed ends a record depends on all quotes before it, and on their number's parity alone, as a quote within a value is doubled. Files
are cut into byte ranges; one pass counts each range's quotes, a running sum over a file's ranges says for each whether it begins within
quotes, and a second pass cuts the records that begin in the range, reading on to the last one's end. Spark's own `from_csv`
parses the records.

Records end with LF or CRLF outside quotes; both are kept within. A byte order mark is dropped. An empty line is a record only where there is one
column: there it is a null, as writers write it. A single record must fit a task's memory.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.sources.objects import store_of

RANGE = 16 << 20
MARK = b"\xef\xbb\xbf"
# only an unquoted nothing is null: the parser then reports this text, which no value has
OPTIONS = {"escape": '"', "multiLine": "true", "lineSep": "\n", "nullValue": "\x00null\x00", "emptyValue": "",
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _ranges(spark: SparkSession, path: str, size: int) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(size).cast("bigint")))
    return files.select("path", "length", start.alias("start")).repartition("path", "start")


def _quotes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for path, start in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                store, inner = store_of(path)
                with store.open_input_file(inner) as source:
                    counts.append(source.read_at(size, start).count(b'"'))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=["path", "length", "start", "quotes"])

    return run


def _ends(data: np.ndarray, inside: int) -> np.ndarray:
    """Places of the line feeds outside quotes, if the data begin inside (1) or outside (0)."""
    feeds = np.flatnonzero(data == 10)
    return feeds[(np.searchsorted(np.flatnonzero(data == 34), feeds) + inside) % 2 == 0]


def _cut(source, start: int, size: int, length: int, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes from `start` on, and where the records that begin in the range begin and end in them."""
    body = source.read_at(size, start)
    data = np.frombuffer(body, np.uint8)
    ends = _ends(data, inside)
    fresh = start == 0 or (not inside and source.read_at(1, start - 1) == b"\n")
    begins = np.concatenate([[0] if fresh else [], ends[ends + 1 < len(data)] + 1]).astype(np.int64)
    if not len(begins):
        return data, begins, begins
    if not len(ends) or ends[-1] < begins[-1]:  # the last record goes on behind the range
        at, rest = start + len(data), []
        inside = (inside + body.count(b'"')) % 2
        while at < length:
            more = np.frombuffer(source.read_at(1 << 16, at), np.uint8)
            found = _ends(more, inside)
            rest.append(more[:found[0] + 1] if len(found) else more)
            if len(found):
                break
            inside, at = (inside + int((more == 34).sum())) % 2, at + len(more)
        data = np.concatenate([data, *rest])
        last = len(data) - 1 if len(data) and rest and data[-1] == 10 and len(rest[-1]) and at < length else len(data)
        ends = np.append(ends, last)
    ends = ends[ends >= begins[0]]
    return data, begins, ends - ((ends > begins) & (data[np.maximum(ends, 1) - 1] == 13) & (ends < len(data)))


def _records(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, start, inside in zip(*(c.to_pylist() for c in batch.columns)):
                store, inner = store_of(path)
                with store.open_input_file(inner) as source:
                    data, begins, ends = _cut(source, start, size, length, inside)
                if start == 0 and data[:3].tobytes() == MARK and len(begins):
                    begins[0] = 3
                view = data.tobytes()
                texts = pa.array([view[a:b] for a, b in zip(begins.tolist(), ends.tolist())], pa.binary()).cast(pa.string(), safe=False)
                header = np.zeros(len(begins), bool)
                header[:1] = start == 0
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(begins), pa.string()), texts, pa.array(header)], names=["path", "record", "header"])

    return run


def csv_records(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """(path, record, header) of all records; `header` marks each file's first."""
    ranges = _ranges(spark, path, size)
    counted = ranges.mapInArrow(_quotes(size), "path STRING, length BIGINT, start BIGINT, quotes BIGINT")
    before = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)  # a number per range
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    placed = counted.select("path", "length", "start", inside.alias("inside")).repartition("path", "start")
    return placed.mapInArrow(_records(size), "path STRING, record STRING, header BOOLEAN")


def _names(record: str) -> list[str]:
    """Column names of a header: empty ones by place, repeated ones with their place."""
    names = next(csv.reader([record], strict=False), [])
    lower = [n.lower() for n in names]
    return [f"_c{k}" if not n else f"{n}{k}" if lower.count(n.lower()) > 1 else n for k, n in enumerate(names)]


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, size: int = RANGE) -> DataFrame:
    """The rows of CSV files with a header each. Without a schema, one more pass infers the types as Spark does."""
    records = csv_records(spark, path, size)
    first = records.where("header").orderBy("path").select("record").take(1)
    names = _names(first[0]["record"]) if first else []
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    rows = records.where("not header")
    rows = rows if len(schema.fields if schema is not None else names) == 1 else rows.where("record <> ''")
    if schema is None:
        reader = spark.read.options(**OPTIONS).option("header", False).option("inferSchema", True)
        texts = getattr(rows.select("record")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        kinds = [f.dataType for f in reader._df(reader._jreader.csv(texts)).schema.fields]
        schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds + [T.StringType()] * len(names))])
    if not schema.fields:
        return spark.createDataFrame([], schema)
    return rows.select(F.from_csv("record", _ddl(schema), OPTIONS).alias("_row")).select("_row.*")
