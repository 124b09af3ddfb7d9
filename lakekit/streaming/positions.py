"""A stream of Parquet files whose offsets are row positions, so a micro-batch holds at most `max_messages` rows.

File sources bound a batch by files, whatever their size. Here a batch ends after so many rows, in the middle of a file if need be, and
the next begins there. Files come in order of modification time, then name; a file must be whole when it appears, under a time no
earlier than those already read (as when writers move files in). An offset is the last file begun and the number of its rows taken, however many
files came before. The driver reads the footers of a batch's files only; tasks read the rows, one stretch of a row group or less each.

On a restart the position comes from the query's own checkpoint, whose offset log names the last batch planned: `checkpoint` must be the folder
given to the writer, and the stream the query's only source.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema

from lakekit.sources.objects import store_of

START = {"time": 0, "file": "", "row": 0}


class Stretch(ds.InputPartition):
    """Rows `low` to `high` of a row group of a file."""

    def __init__(self, path: str, group: int, low: int, high: int):
        super().__init__(path)
        self.path, self.group, self.low, self.high = path, group, low, high


def last_planned(checkpoint: str) -> dict | None:
    """The end offset of the last batch in a query's offset log."""
    store, base = store_of(checkpoint)
    log = store.get_file_info(pafs.FileSelector(f"{base}/offsets", allow_not_found=True))
    batches = [int(i.base_name) for i in log if i.base_name.isdigit()]
    if not batches:
        return None
    with store.open_input_file(f"{base}/offsets/{max(batches)}") as source:
        return json.loads(source.read().decode().splitlines()[-1])


class PositionReader(ds.DataSourceStreamReader):
    def __init__(self, folder: str, most: int, checkpoint: str, schema):
        self.folder, self.most, self.checkpoint, self.schema = folder, most, checkpoint, schema
        self.at: dict | None = None
        self.sizes: dict[str, list[int]] = {}

    def _files(self) -> list[tuple[int, str]]:
        store, base = store_of(self.folder)
        found = store.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        return sorted((i.mtime_ns or 0, i.path[len(base):].lstrip("/")) for i in found
                      if i.type == pafs.FileType.File and i.base_name.endswith(".parquet"))

    def _groups(self, name: str) -> list[int]:
        """Rows of each row group of a file."""
        if name not in self.sizes:
            store, base = store_of(self.folder)
            with store.open_input_file(f"{base}/{name}") as source:
                footer = pq.ParquetFile(source).metadata
            self.sizes[name] = [footer.row_group(k).num_rows for k in range(footer.num_row_groups)]
        return self.sizes[name]

    def _after(self, start: dict) -> Iterator[tuple[int, str, int, int]]:
        """(time, file, first row, rows) of what there is from a position on."""
        for time, name in self._files():
            if (time, name) >= (start["time"], start["file"]):
                done = start["row"] if (time, name) == (start["time"], start["file"]) else 0
                total = sum(self._groups(name))
                if total > done:
                    yield time, name, done, total

    def initialOffset(self) -> dict:
        return START

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = last_planned(self.checkpoint) or START
        left = self.most
        for time, name, done, total in self._after(self.at):
            take = min(left, total - done)
            self.at = {"time": time, "file": name, "row": done + take}
            left -= take
            if not left:
                break
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for time, name, done, total in self._after(start):
            if (time, name) > (end["time"], end["file"]):
                break
            stop = end["row"] if (time, name) == (end["time"], end["file"]) else total
            begin = 0
            for group, rows in enumerate(self._groups(name)):
                low, high = max(done - begin, 0), min(stop - begin, rows)
                if low < high:
                    out.append(Stretch(name, group, low, high))
                begin += rows
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        store, base = store_of(self.folder)
        wanted = to_arrow_schema(self.schema)
        with store.open_input_file(f"{base}/{partition.path}") as source:
            at = 0
            for batch in pq.ParquetFile(source).iter_batches(row_groups=[partition.group], columns=wanted.names):
                low, high = max(partition.low - at, 0), min(partition.high - at, batch.num_rows)
                at += batch.num_rows
                if low < high:
                    yield from pa.Table.from_batches([batch.slice(low, high - low)]).select(wanted.names).cast(wanted).to_batches()

    def commit(self, end: dict) -> None:
        self.sizes = {name: rows for name, rows in self.sizes.items() if name == end["file"]}


class PositionSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "positions"

    def schema(self) -> str:
        raise ValueError("a stream by positions needs its schema")

    def streamReader(self, schema) -> PositionReader:
        return PositionReader(self.options["path"], int(self.options["max_messages"]), self.options["checkpoint"], schema)


def position_stream(spark: SparkSession, folder: str, schema, max_messages: int, checkpoint: str) -> DataFrame:
    """Rows of the Parquet files below a folder as a stream of batches of at most `max_messages` rows."""
    if max_messages < 1:
        raise ValueError("a batch needs at least one message")
    spark.dataSource.register(PositionSource)
    return (spark.readStream.format("positions").schema(schema).option("max_messages", str(max_messages))
            .option("checkpoint", checkpoint).load(folder))
