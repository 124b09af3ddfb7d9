"""Row renderers: JSON text, JSON cells and the compact row text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def _fraction(stamp: Column) -> Column:
    """`.mmm` or `.uuuuuu` of a time, nothing for whole seconds."""
    micros = F.pmod(F.unix_micros(stamp), F.lit(1_000_000))
    digits = F.lpad(micros.cast("string"), 6, "0")
    return F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.when(micros % 1000 == 0, F.substring(digits, 1, 3)).otherwise(digits)))


def _exact_times(col: Column, kind: T.DataType) -> Column:
    """The value with its times as text: RFC 3339 with an offset, or six digits without one."""
    if isinstance(kind, T.TimestampType):
        whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
        return F.concat(whole, _fraction(col), F.date_format(col, "xxx"))
    if isinstance(kind, T.TimestampNTZType):
        return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(*[_exact_times(col[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _exact_times(x, kind.elementType))
    if isinstance(kind, T.MapType):  # keys are text in JSON, and times among them may not merge
        return F.transform_values(F.transform_keys(col, lambda k, v: _exact_times(k, kind.keyType)), lambda k, v: _exact_times(v, kind.valueType))
    return col


def _columns(df: DataFrame) -> list[Column]:
    return [_exact_times(F.col("`" + f.name + "`"), f.dataType).alias(f.name) for f in df.schema.fields]


def rows_to_json(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON object per row, null fields kept, times exact."""
    return df.select(F.to_json(F.struct(*_columns(df)), JSON_KEEP_NULLS).alias(name))


def rows_to_json_cells(df: DataFrame) -> DataFrame:
    """Every cell as its own JSON text: strings quoted, nulls spelled `null`, times exact."""

    def cell(name: str) -> Column:
        # to_json takes no bare scalar, so wrap in a one-element array and drop the brackets
        wrapped = F.to_json(F.array(F.col(f"`{name}`")), JSON_KEEP_NULLS)
        return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2).alias(name)

    return df.select(*_columns(df)).select(*[cell(c) for c in df.columns])


def plain_number(text: Column) -> Column:
    """A number's text without exponent: its digits with the point moved, never through a number type."""
    sign = F.when(text.startswith("-"), "-").otherwise("")
    mantissa = F.regexp_replace(F.regexp_extract(text, "^-?([0-9.]+)", 1), r"\.0$", "")
    digits, power = F.replace(mantissa, F.lit("."), F.lit("")), F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int")
    size = F.length(digits)
    moved = (F.when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits))
             .when(size <= power + 1, F.concat(digits, F.repeat(F.lit("0"), power + 1 - size)))
             .otherwise(F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, size))))
    return F.when(text.contains("E"), F.concat(sign, moved)).otherwise(F.regexp_replace(text, r"\.0$", ""))


def _number_text(col: Column) -> Column:
    """Shortest decimal text of a double without exponent: 3.0 is `3`, 1e-4 is `0.0001`."""
    return F.when(F.isnan(col), F.lit("NaN")).when(F.abs(col) == float("inf"), F.when(col > 0, "inf").otherwise("-inf")) \
        .otherwise(plain_number(col.cast("string")))


def _value_text(col: Column, kind: T.DataType) -> Column:
    """Text of a value; SQL null stays null here, callers decide how it prints."""

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    if isinstance(kind, T.StringType):
        return quoted(col)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _number_text(col)
    if isinstance(kind, T.TimestampType):
        return quoted(F.concat(F.date_format(col, "yyyy-MM-dd HH:mm:ss"), _fraction(col), F.lit(" UTC")))
    if isinstance(kind, T.TimestampNTZType):
        return quoted(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    if isinstance(kind, T.DateType):
        return quoted(F.date_format(col, "yyyy-MM-dd"))
    if isinstance(kind, T.StructType):
        return _record_text([(f.name, col[f.name], f.dataType) for f in kind.fields], col)
    if isinstance(kind, T.ArrayType):
        items = F.transform(col, lambda x: F.coalesce(_value_text(x, kind.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    return col.cast("string")


def _record_text(fields, whole: Column | None) -> Column:
    # concat is null for a null value and concat_ws skips nulls: null columns vanish
    cells = [F.concat(F.lit(f'"{name}": '), _value_text(col, kind)) for name, col, kind in fields]
    text = F.concat(F.lit("{"), F.concat_ws(",", *cells), F.lit("}"))
    return text if whole is None else F.when(whole.isNotNull(), text)


def rows_to_text(df: DataFrame, name: str = "row_text") -> DataFrame:
    """Compact row text: null columns dropped, null array items `null`, strings not escaped."""
    return df.select(_record_text([(f.name, F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields], None)
                     .alias(name))
