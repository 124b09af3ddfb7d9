"""Write a result by file extension; object puts as text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.sources.inputs import format_of

# Writable formats (`njson` is read but not written).
WRITE_FORMATS = {"json": "json", "parquet": "parquet", "csv": "csv"}


TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_result(df: DataFrame, path: str, remove: bool = False) -> str:
    """Write by extension; an existing target is an error unless `remove` replaces it."""
    kind = format_of(path, WRITE_FORMATS)
    writer = df.write.mode("overwrite" if remove else "errorifexists")
    if kind in ("csv", "json"):  # times with all their digits
        writer = writer.options(**TIMES)
    if kind == "csv":  # quotes are doubled, blanks kept; null is nothing at all and the empty text is ""
        writer = (writer.option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", '""')
                  .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("lineSep", "\n"))
    if kind == "csv" and len(df.columns) == 1:  # the writer passes over an empty record, which is what a lone null is
        _lines(df).write.mode("overwrite" if remove else "errorifexists").text(path)
        return path
    if kind == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(kind).save(path)
    return path


def _lines(df: DataFrame) -> DataFrame:
    """One column as CSV lines, each file's first the header: texts in quotes, null an empty line."""
    name = df.columns[0]
    cell = F.col("`" + name.replace("`", "``") + "`")
    if not isinstance(df.schema[0].dataType, T.StringType):
        cell = F.to_csv(F.struct(cell.alias("v")), TIMES)
    quoted = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
    header = '"' + name.replace('"', '""') + '"'

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([header])], names=["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    return df.select(F.when(df[df.columns[0]].isNull(), "").otherwise(quoted).alias("value")).mapInArrow(with_header, "value STRING")


def put_text_objects(df: DataFrame, text: str, path: str, max_lines: int = 100_000) -> str:
    """Put one text column as line objects of bounded size under `path`."""
    df.select(F.col(text).alias("value")).write.option("maxRecordsPerFile", max_lines).text(path)
    return path
