"""Objects under a path as a Spark data source: `spark.read.format("objects").load(path)`.

One row per object: name (below the path, as it is), path, length, modificationTime. Every object is listed, empty ones and
names that begin with `_` or `.` too, which file scans pass over. Conditions on the name (equality, bounds, prefixes) go to the
lister, which enters only folders that can hold such names.

The driver lists at most SPLITS folders, from the pushed prefix on and breadth first, to find where to part the names;
tasks walk what is below them. One folder's own objects are one partition, and one folder's listing is held at a time.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

SCHEMA = "name STRING, path STRING, length BIGINT, modificationTime TIMESTAMP"
SPLITS = 64
LISTED = 4096  # objects handed on at a time
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URL, and the path inside it. Blanks and percent signs stand for themselves."""
    path = re.sub(r"^file:/(?!/)", "file:///", path.rstrip("/"))  # as listings of Spark spell it
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", path):
        return pafs.FileSystem.from_uri(quote(path, safe="/:?&=@,"))
    return pafs.LocalFileSystem(), path


class NameRange:
    """Names from `low` to below `high` (None: no end) that begin with each of `prefixes`."""

    def __init__(self, low: str = "", high: str | None = None, prefixes: tuple[str, ...] = ()):
        self.low, self.high, self.prefixes = low, high, prefixes

    def push(self, condition: ds.Filter) -> bool:
        """Narrow the range by a condition on the name; False if it says something else."""
        if getattr(condition, "attribute", None) != ("name",) or not isinstance(getattr(condition, "value", None), str):
            return False
        value, after = condition.value, condition.value + "\0"  # the next name in order
        if isinstance(condition, ds.StringStartsWith):
            self.prefixes += (value,)
        elif isinstance(condition, (ds.EqualTo, ds.EqualNullSafe)):
            self._bound(value, after)
        elif isinstance(condition, (ds.GreaterThanOrEqual, ds.GreaterThan)):
            self._bound(after if isinstance(condition, ds.GreaterThan) else value, None)
        elif isinstance(condition, (ds.LessThan, ds.LessThanOrEqual)):
            self._bound("", after if isinstance(condition, ds.LessThanOrEqual) else value)
        else:
            return False
        return True

    def _bound(self, low: str, high: str | None) -> None:
        self.low = max(self.low, low)
        if high is not None:
            self.high = high if self.high is None else min(self.high, high)

    def holds(self, name: str) -> bool:
        return name >= self.low and (self.high is None or name < self.high) and all(name.startswith(p) for p in self.prefixes)

    def meets(self, folder: str) -> bool:
        """Whether a name below the folder (which ends in a slash, or is empty) can be in the range."""
        return ((folder >= self.low or self.low.startswith(folder)) and (self.high is None or folder < self.high or not folder)
                and all(folder.startswith(p) or p.startswith(folder) for p in self.prefixes))

    def start(self) -> str:
        """The deepest folder that holds every name of the range."""
        longest = max(self.prefixes, key=len, default="")
        return longest[:longest.rfind("/") + 1]


class Folder(ds.InputPartition):
    """A folder's own objects, or everything below it."""

    def __init__(self, name: str, deep: bool):
        super().__init__(name)
        self.name, self.deep = name, deep


class ObjectReader(ds.DataSourceReader):
    def __init__(self, path: str, splits: int):
        self.path, self.splits, self.names = path.rstrip("/"), splits, NameRange()

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        return [f for f in filters if not self.names.push(f)]

    def _list(self, folder: str) -> tuple[list[pafs.FileInfo], list[str]]:
        """The objects right in a folder and its folders, as far as the range goes; none if it isn't there."""
        store, base = store_of(self.path)
        found, below = [], []
        for info in store.get_file_info(pafs.FileSelector(f"{base}/{folder}".rstrip("/") or "/", allow_not_found=True)):
            if info.type == pafs.FileType.Directory:
                if self.names.meets(f"{folder}{info.base_name}/"):
                    below.append(f"{folder}{info.base_name}/")
            elif self.names.holds(folder + info.base_name):
                found.append(info)
        return found, below

    def partitions(self) -> list[Folder]:
        todo, out, listed = deque([self.names.start()]), [], 0
        while todo and listed < self.splits:
            folder = todo.popleft()
            found, below = self._list(folder)
            listed += 1
            if found:
                out.append(Folder(folder, False))
            todo += below
        return out + [Folder(f, True) for f in todo] or [Folder(self.names.start(), False)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        todo = deque([partition.name])
        while todo:
            folder = todo.pop()
            found, below = self._list(folder)
            for at in range(0, len(found), LISTED):
                some = found[at:at + LISTED]
                names = [folder + info.base_name for info in some]
                times = [None if info.mtime_ns is None else info.mtime_ns // 1000 for info in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([f"{self.path}/{name}" for name in names], pa.string()),
                     pa.array([info.size for info in some], pa.int64()), pa.array(times, pa.timestamp("us", "UTC"))],
                    names=["name", "path", "length", "modificationTime"])
            if partition.deep:
                todo += below


class ObjectSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ObjectReader:
        return ObjectReader(self.options["path"], int(self.options.get("splits", SPLITS)))


def read_objects(spark: SparkSession, path: str, splits: int = SPLITS):
    """The objects under `path` as a DataFrame; where() on the name is pushed to the lister."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(ObjectSource)
    return spark.read.format("objects").option("splits", str(splits)).load(path)
