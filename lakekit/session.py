"""Session defaults, session SQL functions and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings the operators rely on. Partition counts and memory are left
# to the cluster; AQE coalesces and splits shuffle partitions from there.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM never compiles methods over 8000 bytes, so wide projections are better split than fused
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# pow is a built-in name Spark refuses to shadow, so C-style pow is `cpow`.
SESSION_FUNCTIONS = (
    """
    CREATE OR REPLACE TEMPORARY FUNCTION cpow(base DOUBLE, expo DOUBLE) RETURNS DOUBLE
    RETURN CASE WHEN base IS NULL OR expo IS NULL THEN NULL
                WHEN base = 1 THEN 1D
                WHEN base = -1 AND abs(expo) = double('inf') THEN 1D
                ELSE power(base, expo) END
    """,
    # what is joined starts at the first text that is not empty, so one pass over the array is enough
    """
    CREATE OR REPLACE TEMPORARY FUNCTION newline_join(parts ARRAY<STRING>) RETURNS STRING
    RETURN CASE WHEN parts IS NOT NULL THEN
             CASE WHEN exists(parts, x -> coalesce(length(x) > 0, false))
                  THEN array_join(slice(array_compact(parts), cast(array_position(
                         transform(array_compact(parts), x -> length(x) > 0), true) AS INT), size(parts)), '\\n')
                  ELSE '' END END
    """,
    # the newline aggregate is newline_text(listagg(newline_item(x), '\n') WITHIN GROUP (ORDER BY ...)): each text that is not empty gets a mark,
    # so empty texts before the first one are told from line feeds it begins with; marks in texts are doubled
    """
    CREATE OR REPLACE TEMPORARY FUNCTION newline_item(x STRING) RETURNS STRING
    RETURN CASE WHEN x = '' THEN '' ELSE concat(chr(1), replace(x, chr(1), concat(chr(1), chr(1)))) END
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION newline_text(joined STRING) RETURNS STRING
    RETURN coalesce(regexp_replace(regexp_replace(joined, '^\\\\n+', ''), '\\\\x01(\\\\x01?)', '$1'), '')
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION int_div(a BIGINT, b BIGINT) RETURNS BIGINT
    RETURN a div b
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION date_bin(width INTERVAL DAY TO SECOND, ts TIMESTAMP) RETURNS TIMESTAMP
    RETURN timestamp_micros(unix_micros(ts) - pmod(unix_micros(ts),
             cast(extract(DAY FROM width) AS BIGINT) * 86400000000 + extract(HOUR FROM width) * 3600000000
             + extract(MINUTE FROM width) * 60000000 + cast(extract(SECOND FROM width) * 1000000 AS BIGINT)))
    """,
)


SHUFFLE_TARGET = 512 << 20  # bytes one shuffle partition should hold


def shuffle_partitions_for(data_bytes: int) -> int:
    """Shuffle partitions for the data a job moves. AQE merges small partitions but never makes more."""
    return max(200, -(-data_bytes // SHUFFLE_TARGET))


def build_session(app: str = "lakekit", master: str | None = None, data_bytes: int | None = None,
                  **conf: str) -> SparkSession:
    """A configured session; `data_bytes`, the size of the largest shuffle, sets the partition count."""
    if data_bytes is not None:
        conf.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions_for(data_bytes)))
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and register the SQL functions once per session."""
    if spark.conf.get("lakekit.configured", "") == "yes":
        return spark
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for ddl in SESSION_FUNCTIONS:
        spark.sql(ddl)
    spark.conf.set("lakekit.configured", "yes")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Base folder every executor can reach: the one named in spark.checkpoint.dir.

    Only a local session, whose tasks all run on this machine, may fall back to
    a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = spark.conf.get("lakekit.local.scratch", None)
    if not base:
        base = tempfile.mkdtemp(prefix="lakekit-")
        spark.conf.set("lakekit.local.scratch", base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []  # paths handed out in this process


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this process wrote under the shared folder; results read from there must be stored first."""
    deleted = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        deleted += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return deleted


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Executions in here delete their shuffle files once they have ended: what they write is all that is read from then on."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate whose successor is written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df):
    """The rows written to the shared folder and read back, so that later reads prune and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, "rows")
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
