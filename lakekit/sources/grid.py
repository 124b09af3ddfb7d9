"""Spreadsheet grids: a 2-D value array per sheet turned into typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grid_to_table(sheets: DataFrame, grid: str, columns: dict[str, str]) -> DataFrame:
    """Rows of every sheet; the first grid row names the columns, `columns` gives their types.

    Cells are found by header name, so sheets may order columns differently; a
    missing column or a short row gives null.
    """
    keep = [c for c in sheets.columns if c != grid]
    body = sheets.select(
        *keep, F.get(F.col(grid), F.lit(0)).alias("_header"),
        F.posexplode(F.slice(grid, F.lit(2), F.greatest(F.size(grid) - 1, F.lit(0)))).alias("row_number", "_cells"))
    cells = [
        F.get(F.col("_cells"), F.array_position("_header", name).cast("int") - 1).cast(kind).alias(name)
        for name, kind in columns.items()
    ]
    return body.select(*keep, "row_number", *cells)
