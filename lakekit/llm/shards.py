"""Tables whose rows are whole index shards of some megabytes each, written and read one by one.

Parquet looks at sizes after a hundred rows: pages, groups and the reader's batches would hold a task's shards all at once, however many
its input gives. Here every row is a page of its own and a few fill a group, which is what a reader holds; columns of a batch are read as views.
Statistics are off, as a writer keeps the least and largest value of each page and group, whole shards here, until its file ends.
Texts go to the workers that make shards in small batches, as Arrow's buffers lie outside the heap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

GROUP_BYTES = 8 << 20
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
_ROW_BY_ROW = {"parquet.block.size": GROUP_BYTES, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1,
               "parquet.page.row.count.limit": 1, "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false",
               "parquet.size.statistics.enabled": "false", "compression": "zstd"}


def write_shards(shards: DataFrame, path: str) -> DataFrame:
    """The shards written to `path`, and as read back."""
    spark = shards.sparkSession
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        shards.write.options(**_ROW_BY_ROW).parquet(path)
    finally:
        spark.conf.set(BATCH, before)
    return spark.read.schema(shards.schema).parquet(path)


def arrays(batch: pa.RecordBatch, kinds: dict[str, type]) -> Iterator[dict[str, np.ndarray]]:
    """The binary columns `kinds` of each row as arrays of these types, without copying them."""
    columns = {name: (batch.column(name), kind) for name, kind in kinds.items()}
    for k in range(batch.num_rows):
        yield {name: np.frombuffer(column[k].as_buffer(), kind) for name, (column, kind) in columns.items()}
