"""Object inventories: listing, prefix rollup, buckets, metadata and contents."""

from __future__ import annotations

import fnmatch
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.scalars import mime_guess, mime_normalize, split_object_url
from lakekit.session import cut_lineage
from lakekit.sources.objects import read_objects, store_of

HANDED_ON = 4 << 20  # characters of objects handed on together; one object is handed on whole


def inventory_from_urls(df: DataFrame, url: str, *keep: str) -> DataFrame:
    """An inventory (bucket, name, content_type) read off an URL column."""
    parts = split_object_url(F.col(url))
    return df.select(*keep, parts["bucket"].alias("bucket"), parts["path"].alias("name"),
                     mime_guess(parts["path"]).alias("content_type"))


def inventory_from_files(spark: SparkSession, path: str, glob: str | None = None, prefix: str = "") -> DataFrame:
    """Object metadata (name, path, length, modificationTime), no bodies. The prefix goes to the lister; the glob is on a name's last part."""
    found = read_objects(spark, path)
    if prefix.removeprefix("/"):
        found = found.where(F.col("name").startswith(prefix.removeprefix("/")))
    return found.where(F.element_at(F.split("name", "/"), -1).rlike(fnmatch.translate(glob))) if glob else found


def list_objects(inventory: DataFrame, prefix: str | None = None, start: str | None = None,
                 end: str | None = None, bucket: str | None = None) -> DataFrame:
    """Objects under a prefix (one leading slash is ignored) with start <= name < end."""
    out = inventory
    if bucket is not None:
        out = out.where(F.col("bucket") == bucket)
    if prefix:
        out = out.where(F.col("name").startswith(prefix.removeprefix("/")))
    if start is not None:
        out = out.where(F.col("name") >= start)
    if end is not None:
        out = out.where(F.col("name") < end)
    return out


def list_common_prefixes(inventory: DataFrame, delimiter: str, prefix: str = "") -> DataFrame:
    """Distinct folders (bucket, name) right under a prefix; plain objects are left out."""
    head = prefix.removeprefix("/")
    rest = F.substring(F.col("name"), F.lit(len(head) + 1), F.length("name"))
    return (
        list_objects(inventory, head)
        .where(rest.contains(delimiter))
        .select("bucket", F.concat(F.lit(head), F.substring_index(rest, delimiter, 1), F.lit(delimiter)).alias("name"))
        .distinct()
    )


def list_buckets(inventory: DataFrame, prefix: str = "") -> DataFrame:
    return inventory.where(F.col("bucket").startswith(prefix)).select("bucket").distinct()


def _named(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """The folder of a path, and the objects it names: one object, those of a pattern in the last part, or all below a folder."""
    base, _, last = path.rstrip("/").rpartition("/")
    if re.search(r"[*?\[]", last):
        found = read_objects(spark, base)
        return base, found.where(~F.col("name").contains("/") & F.col("name").rlike(fnmatch.translate(last)))
    store, inner = store_of(path)
    if store.get_file_info(inner).type == pafs.FileType.File:
        return base, read_objects(spark, base).where(F.col("name") == last)
    return path.rstrip("/"), read_objects(spark, path)


def read_text_objects(spark: SparkSession, path: str) -> DataFrame:
    """Whole objects as strict UTF-8 text: (path, text). Invalid bytes are an error, an empty object is the empty text.

    An object is one value, as large as it is; use `read_binary_chunks` for objects beyond a worker's memory.
    """
    base, objects = _named(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inner = store_of(base)
        for batch in batches:
            paths, texts, size = [], [], 0
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{inner}/{name}") as source:
                    try:
                        text = source.read().decode()
                    except UnicodeDecodeError as wrong:
                        raise ValueError(f"object {name!r} is not UTF-8: {wrong}") from None
                paths.append(f"{base}/{name}")
                texts.append(text)
                size += len(text)
                if size >= HANDED_ON:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(texts)], names=["path", "text"])
                    paths, texts, size = [], [], 0
            if paths:
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(texts)], names=["path", "text"])

    return objects.select("name").repartition("name").mapInArrow(read, "path STRING, text STRING")


def read_binary_chunks(spark: SparkSession, path: str, chunk: int = 1 << 20) -> DataFrame:
    """Objects as byte streams: (path, position, bytes) in chunks of bounded size; an empty object is one empty chunk.

    The listing gives one row per range; tasks seek and read their ranges, so no object is ever held as a
    whole. The ranges are read through Arrow's file systems (local, HDFS, S3, GCS), by name.
    """
    base, objects = _named(spark, path)
    position = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(chunk).cast("bigint")))
    ranges = objects.select("name", position.alias("position")).repartition("name", "position")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inner = store_of(base)
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(f"{inner}/{name}") as source:
                    body = source.read_at(chunk, start)
                yield pa.RecordBatch.from_arrays([pa.array([f"{base}/{name}"]), pa.array([start], pa.int64()), pa.array([body], pa.binary())],
                                                 names=["path", "position", "bytes"])

    return ranges.mapInArrow(read, "path STRING, position BIGINT, bytes BINARY")


def put_objects(df: DataFrame, name: str, body: str, path: str, content_type: str | None = None) -> DataFrame:
    """Put each row's body under its own name below `path`; returns (name, content_type, size).

    An object is written aside, outside the folder, and moved to its name, so a repeated task leaves it whole. The type is the
    given column's, put in order, or guessed from the name. Names that are null or empty, or have an empty, `.` or `..` part
    and so would leave the folder or share a place, are refused before anything is written. Of rows with one name any one stays, whole.
    """
    refused = df.where(F.col(name).isNull() | F.exists(F.split(F.col(name), "/"), lambda part: part.isin("", ".", ".."))).select(name).take(1)
    if refused:
        raise ValueError(f"no name for an object below {path}: {refused[0][0]!r}")
    kind = mime_normalize(F.col(content_type)) if content_type else F.lit(None).cast("string")
    rows = df.select(F.col(name).alias("name"), F.coalesce(kind, mime_guess(F.col(name))).alias("content_type"),
                     F.col(body).cast("binary").alias("body"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(path)
        store.create_dir(f"{base}.aside", recursive=True)
        made = set()  # folders of the last objects
        for batch in batches:
            sizes = []
            for own, content in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                target = f"{base}/{own}"
                folder = target.rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made = {folder} if len(made) >= 1000 else made | {folder}
                aside = f"{base}.aside/{uuid.uuid4().hex}"
                with store.open_output_stream(aside) as sink:
                    sink.write(content or b"")
                store.move(aside, target)
                sizes.append(len(content or b""))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["name", "content_type", "size"])

    done = cut_lineage(rows.mapInArrow(put, "name STRING, content_type STRING, size BIGINT"))
    store, base = store_of(path)
    if store.get_file_info(f"{base}.aside").type == pafs.FileType.Directory:
        store.delete_dir(f"{base}.aside")  # what ended tasks left
    return done
