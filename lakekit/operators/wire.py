"""Semi-structured warehouse rows: declared schemas and typed decoding of JSON cells.

A line is `{"f": [{"v": cell}, ...]}`. A cell is a JSON string, number, boolean,
null, an array of cells (repeated) or an object `{"f": [...]}` (record). The
decoder is one expression tree generated from the declared schema; no Python runs
per row. Lines of the usual shape are read as typed texts, in one parse if they are written without blanks, the
others as VARIANT values, where the kind of each JSON token is known.
"""

from __future__ import annotations

import dataclasses
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.functions import fixed_values as fixed
from lakekit.functions.render import plain_number
from lakekit.functions.scalars import lookup


@dataclasses.dataclass(frozen=True)
class WireField:
    """One declared column; `fields` are a record's columns."""

    name: str
    type: str
    mode: str = "NULLABLE"
    fields: tuple["WireField", ...] = ()
    description: str | None = None


# Spark type of each declared type.
SPARK_TYPES = {
    "STRING": T.StringType(), "INTEGER": T.LongType(), "FLOAT": T.DoubleType(), "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(), "DATETIME": T.TimestampNTZType(), "DATE": T.DateType(),
    "TIME": T.StringType(), "JSON": T.StringType(), "UNKNOWN": T.StringType(),
}


def read_field(spec: dict) -> WireField:
    """A declared column from its JSON form, types and modes mapped for reading."""
    return WireField(
        spec.get("name") or "",
        fixed.READ_TYPE.get(spec["type"], fixed.READ_TYPE_DEFAULT),
        spec["mode"] if spec.get("mode") in fixed.MODES else fixed.MODE_DEFAULT,
        tuple(read_field(f) for f in spec.get("fields") or ()),
        spec.get("description"),
    )


def write_field(field: WireField) -> dict:
    """The JSON form of a declared column, types mapped for writing; absent parts left out."""
    spec = {"name": field.name, "type": fixed.WRITE_TYPE.get(field.type),
            "mode": field.mode if field.mode in fixed.MODES else None,
            "fields": [write_field(f) for f in field.fields] or None, "description": field.description}
    return {k: v for k, v in spec.items() if v is not None}


def to_struct(fields: list[WireField] | tuple[WireField, ...]) -> T.StructType:
    """Spark schema of declared columns; the description becomes the column comment."""

    def one(field: WireField) -> T.StructField:
        kind = to_struct(field.fields) if field.type == "RECORD" else SPARK_TYPES[field.type]
        if field.mode == "REPEATED":
            kind = T.ArrayType(kind)
        meta = {"comment": field.description} if field.description else {}
        return T.StructField(field.name, kind, field.mode != "REQUIRED", meta)

    return T.StructType([one(f) for f in fields])


def from_struct(schema: T.StructType) -> list[WireField]:
    """Declared columns of a Spark schema."""
    names = {T.StringType: "STRING", T.ByteType: "INTEGER", T.ShortType: "INTEGER", T.IntegerType: "INTEGER",
             T.LongType: "INTEGER", T.FloatType: "FLOAT", T.DoubleType: "FLOAT", T.DecimalType: "FLOAT",
             T.BooleanType: "BOOLEAN", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "DATETIME",
             T.DateType: "DATE"}

    def one(field: T.StructField) -> WireField:
        kind, mode = field.dataType, "NULLABLE" if field.nullable else "REQUIRED"
        if isinstance(kind, T.ArrayType):
            kind, mode = kind.elementType, "REPEATED"
        comment = field.metadata.get("comment")
        if isinstance(kind, T.StructType):
            return WireField(field.name, "RECORD", mode, tuple(from_struct(kind)), comment)
        return WireField(field.name, names.get(type(kind), "UNKNOWN"), mode, (), comment)

    return [one(f) for f in schema.fields]


def map_declared_columns(columns: DataFrame) -> DataFrame:
    """Type and mode mapping as a job over a table of column declarations (type, mode)."""
    kind, mode = F.col("type"), F.coalesce(F.col("mode"), F.lit(""))
    read = lookup(kind, fixed.READ_TYPE, fixed.READ_TYPE_DEFAULT)
    return columns.withColumns({
        "read_type": read,
        "write_type": lookup(read, fixed.WRITE_TYPE),
        "read_mode": F.when(mode.isin(*fixed.MODES), mode).otherwise(fixed.MODE_DEFAULT),
    })


# ---------------------------------------------------------------- decoding

# Texts accepted for each type; anything else takes the lenient default.
_INTEGER = r"\A[+-]?[0-9]+\z"
_FLOAT = r"\A[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\z"
_DATE = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
_DATETIME = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]+)?\z"
_TIME = r"\A[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]+)?\z"
_MAX_SECONDS = 253_402_300_799  # end of year 9999
_TIMED = ("DATE", "DATETIME", "TIME", "TIMESTAMP")


def _null(kind: T.DataType) -> Column:
    return F.lit(None).cast(kind)


def _seconds(number: Column) -> Column:
    """Timestamp of whole seconds, null when outside the calendar."""
    return F.when(F.abs(number) <= _MAX_SECONDS, F.timestamp_seconds(number))


def _from_string(text: Column, declared: str, json_text: bool) -> Column:
    """A JSON string under a declared type; null for a null text."""
    if declared == "STRING":
        return text
    if declared == "INTEGER":
        parsed = F.when(text.rlike(_INTEGER), text.try_cast("bigint"))
        return F.when(text.isNotNull(), F.coalesce(parsed, F.lit(0).cast("bigint")))
    if declared == "FLOAT":
        parsed = F.when(text.rlike(_FLOAT), text.try_cast("double"))
        return F.when(text.isNotNull(), F.coalesce(parsed, F.lit(0.0)))
    if declared == "BOOLEAN":
        return text == "true"
    if declared == "TIMESTAMP":
        parsed = F.when(text.rlike(_FLOAT), text.try_cast("double"))
        parsed = F.coalesce(F.when(F.isnan(parsed), F.lit(0.0)).otherwise(parsed), F.lit(0.0))
        inside = F.when(F.abs(parsed) <= _MAX_SECONDS, parsed).cast("bigint")  # cast drops the fraction
        return F.when(text.isNotNull(), _seconds(inside))
    if declared == "DATETIME":
        return F.when(text.rlike(_DATETIME), text.try_cast("timestamp_ntz"))
    if declared == "DATE":
        return F.when(text.rlike(_DATE), text.try_cast("date"))
    if declared == "TIME":
        stamp = F.when(text.rlike(_TIME), F.concat(F.lit("1970-01-01 "), text).try_cast("timestamp_ntz"))
        return F.date_format(stamp, "HH:mm:ss")
    if declared == "JSON" and json_text:
        return text
    return _null(SPARK_TYPES[declared])


# ---- plain lines: usual ones (see below) without blanks between tokens, their keys written `f` and `v`
#
# One pattern tells them, and one parse reads them: the key of a box that holds a list becomes `a`, of one that holds a
# record `r`, so cells of every kind fit one struct. Outside of strings only, as a quote within a string has a backslash before it.

def _plain_line(fields: list[WireField]) -> str:
    return rf"\A{_shape(fields, _STRING, '"v"', '"f"')}\z"


def _plain_schema(fields: list[WireField] | tuple[WireField, ...]) -> str:
    """Type of a cell that may be any of these columns."""
    kinds = ["v:string"]
    lists = [dataclasses.replace(f, mode="NULLABLE") for f in fields if f.mode == "REPEATED"]
    records = [f for f in fields if f.mode != "REPEATED" and f.type == "RECORD"]
    if lists:
        kinds.append(f"a:array<{_plain_schema(lists)}>")
    if records:
        kinds.append(f"r:struct<f:array<{_plain_schema([sub for f in records for sub in f.fields])}>>")
    return f"struct<{','.join(kinds)}>"


def _plain_text(text: Column) -> Column:
    named = F.replace(text, F.lit('{"v":['), F.lit('{"a":['))
    return F.replace(named, F.lit('{"v":{"f":['), F.lit('{"r":{"f":['))


def _plain_cell(cell: Column, field: WireField, json_text: bool) -> Column:
    if field.mode == "REPEATED":
        single = dataclasses.replace(field, mode="NULLABLE")
        return F.transform(cell["a"], lambda x: _plain_cell(x, single, json_text))
    if field.type == "RECORD":
        cells = cell["r"]["f"]
        return F.when(cells.isNotNull(), F.struct(*[
            _plain_cell(F.get(cells, F.lit(k)), f, json_text).alias(f.name) for k, f in enumerate(field.fields)]))
    return _from_string(cell["v"], field.type, json_text)


def _plain_bad(cell: Column, field: WireField) -> Column | None:
    """Whether a time in the cell is unreadable; None where no time is declared."""
    if not _has_time(field):
        return None
    if field.mode == "REPEATED":
        single = dataclasses.replace(field, mode="NULLABLE")
        return F.coalesce(F.exists(cell["a"], lambda x: F.coalesce(_plain_bad(x, single), F.lit(False))), F.lit(False))
    if field.type == "RECORD":
        return _any([_plain_bad(F.get(cell["r"]["f"], F.lit(k)), f) for k, f in enumerate(field.fields) if _has_time(f)])
    return cell["v"].isNotNull() & _from_string(cell["v"], field.type, False).isNull()


# ---- usual lines: strings and nulls only, every cell in its `{"v": ...}` box
#
# A line's skeleton is its text with every JSON string replaced by `s` and blanks removed. A line whose
# skeleton has the declared shape is read as texts, level by level, and cast; any
# other line, and any token that is not a string or null, goes through VARIANT.

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_BOXES = "array<struct<v:string>>"
_RECORD = f"struct<f:{_BOXES}>"


def _shape(fields: tuple[WireField, ...] | list[WireField], string: str = "s", box: str = "s", cells: str = "s") -> str:
    """Pattern of a record, or of its skeleton: its cells in order, later ones may be absent. `box` and `cells` are the keys."""
    tail = ""
    for k, field in reversed(list(enumerate(fields))):
        tail = f"(?:{',' if k else ''}{_box(field, string, box, cells)}{tail})?+"
    return rf"\{{{cells}:\[{tail}\]\}}"


def _box(field: WireField, string: str, box: str, cells: str) -> str:
    inner = _shape(field.fields, string, box, cells) if field.type == "RECORD" else string
    if field.mode == "REPEATED":
        item = rf"\{{{box}:(?:null|{inner})\}}"
        inner = rf"\[(?:{item}(?:,{item})*+)?+\]"
    return rf"\{{{box}:(?:null|{inner})\}}"


def _nested_schema(field: WireField) -> str:
    if field.mode == "REPEATED":
        return f"array<struct<v:{_RECORD}>>" if field.type == "RECORD" else _BOXES
    return _RECORD


def _bind(value: Column, body) -> Column:
    """body(value) with the value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _usual_cell(text: Column, field: WireField, json_text: bool) -> Column:
    """The value of a cell given its text: a string's own, or the JSON of what is nested."""
    if field.type != "RECORD" and field.mode != "REPEATED":
        return _from_string(text, field.type, json_text)
    return _bind(F.from_json(text, _nested_schema(field)), lambda read: _usual_nested(read, field, json_text))


def _usual_nested(read: Column, field: WireField, json_text: bool) -> Column:
    if field.mode == "REPEATED":
        single = dataclasses.replace(field, mode="NULLABLE")
        if field.type == "RECORD":
            return F.transform(read, lambda x: _usual_nested(x["v"], single, json_text))
        return F.transform(read, lambda x: _from_string(x["v"], field.type, json_text))
    return F.when(read["f"].isNotNull(), F.struct(*[
        _usual_cell(F.get(read["f"], F.lit(k))["v"], f, json_text).alias(f.name) for k, f in enumerate(field.fields)]))


def _usual_bad(text: Column, field: WireField) -> Column | None:
    """Whether a time in the cell is unreadable; None where no time is declared."""
    if field.type != "RECORD" and field.mode != "REPEATED":
        return text.isNotNull() & _from_string(text, field.type, False).isNull() if field.type in _TIMED else None
    if not _has_time(field):
        return None
    return _bind(F.from_json(text, _nested_schema(field)), lambda read: _usual_nested_bad(read, field))


def _usual_nested_bad(read: Column, field: WireField) -> Column:
    if field.mode == "REPEATED":
        single = dataclasses.replace(field, mode="NULLABLE")
        if field.type == "RECORD":
            return F.coalesce(F.exists(read, lambda x: _usual_nested_bad(x["v"], single)), F.lit(False))
        return F.coalesce(F.exists(read, lambda x: _usual_bad(x["v"], single)), F.lit(False))
    found = [_usual_bad(F.get(read["f"], F.lit(k))["v"], f) for k, f in enumerate(field.fields) if _has_time(f)]
    return _any(found)


def _has_time(field: WireField) -> bool:
    return field.type in _TIMED or any(map(_has_time, field.fields))


def _any(flags: list[Column]) -> Column:
    out = F.lit(False)
    for flag in flags:
        out = out | F.coalesce(flag, F.lit(False))
    return out


# ---- any other line, token kind by token kind

def _number_text(number: Column) -> Column:
    """A JSON number's text: at least one decimal for a fraction type, an exponent far from 1."""
    java = number.cast("string")
    near = (F.abs(number) >= 1e-5) & (F.abs(number) < 1e16)
    plain = plain_number(java)
    short = F.concat(F.regexp_replace(F.regexp_extract(java, "^(-?[0-9.]+)E", 1), r"\.0$", ""), F.lit("e"), F.regexp_extract(java, "E(-?[0-9]+)$", 1))
    return F.when(~java.contains("E"), java).when(near, F.when(plain.contains("."), plain).otherwise(F.concat(plain, F.lit(".0")))).otherwise(short)


def _scalar(cell: Column, declared: str, json_text: bool) -> Column:
    """Decode one scalar cell: a JSON string, number or boolean under a declared type."""
    kind, text = F.schema_of_variant(cell), F.try_variant_get(cell, "$", "string")
    is_string, is_number = kind == "STRING", kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    whole = F.when(kind == "BIGINT", F.try_variant_get(cell, "$", "bigint"))
    double = F.try_variant_get(cell, "$", "double")
    seconds = _seconds(F.coalesce(whole, F.lit(0)))
    value = F.when(is_string, _from_string(text, declared, json_text))
    if declared == "STRING":
        exact = (kind == "BIGINT") | (kind.startswith("DECIMAL") & (F.abs(double) > 9.2e18))
        return value.when(is_number, F.when(exact, text).otherwise(_number_text(double)))
    if declared == "INTEGER":
        return value.when(is_number, F.coalesce(whole, F.lit(0)))
    if declared == "FLOAT":
        return value.when(is_number, double)
    if declared == "BOOLEAN":
        return value.when(kind == "BOOLEAN", F.try_variant_get(cell, "$", "boolean"))
    if declared == "TIMESTAMP":
        return value.when(is_number, seconds)
    if declared == "DATETIME":
        return value.when(is_number, seconds.cast("timestamp_ntz"))
    if declared == "DATE":
        return value.when(is_number, seconds.cast("date"))
    if declared == "JSON" and json_text:
        return F.when(kind != "VOID", text)
    return value


def _scalar_bad(cell: Column, declared: str) -> Column:
    """A time that cannot be read, or a list where one value is declared."""
    kind = F.schema_of_variant(cell)
    lists = kind.startswith("ARRAY") if declared != "JSON" else F.lit(False)
    if declared not in _TIMED:
        return lists
    read = kind == "STRING" if declared == "TIME" else kind.rlike("^(STRING|BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return lists | (read & _scalar(cell, declared, False).isNull())


def _unwrapped(cell: Column) -> Column:
    """The inner cell of `{"v": cell}`; a record or anything else as it is."""
    return F.when(F.try_variant_get(cell, "$.f", "variant").isNotNull(), cell).otherwise(
        F.coalesce(F.try_variant_get(cell, "$.v", "variant"), cell))


def _items(cell: Column) -> Column:
    return F.try_variant_get(cell, "$", "array<variant>")


def _cells(cell: Column) -> Column:
    return F.try_variant_get(cell, "$.f", "array<variant>")


def _walk(cell: Column, field: WireField, json_text: bool) -> Column:
    """Decode a cell of any shape: bare or boxed items, a lone value for a repeated column."""
    if field.mode == "REPEATED":
        one = partial(_walk_as, dataclasses.replace(field, mode="NULLABLE"), json_text)
        return _bind(_items(cell), lambda xs: F.when(xs.isNotNull(), F.transform(xs, lambda x: _bind(_unwrapped(x), one)))
                     .when(cell.isNotNull() & ~F.is_variant_null(cell), F.array(one(cell))))
    if field.type == "RECORD":
        return _bind(_cells(cell), lambda xs: F.when(xs.isNotNull(), F.struct(*[
            _bind(_unwrapped(F.get(xs, F.lit(k))), partial(_walk_as, f, json_text)).alias(f.name)
            for k, f in enumerate(field.fields)])))
    return _scalar(cell, field.type, json_text)


def _walk_as(field: WireField, json_text: bool, cell: Column) -> Column:
    return _walk(cell, field, json_text)


def _walk_bad(field: WireField, cell: Column) -> Column:
    """Whether anything in the cell cannot be read."""
    if field.mode == "REPEATED":
        one = partial(_walk_bad, dataclasses.replace(field, mode="NULLABLE"))
        return _bind(_items(cell), lambda xs: F.when(xs.isNotNull(), F.exists(
            xs, lambda x: F.coalesce(_bind(_unwrapped(x), one), F.lit(False)))).otherwise(F.coalesce(one(cell), F.lit(False))))
    if field.type == "RECORD":
        return _bind(_cells(cell), lambda xs: F.coalesce(F.size(xs) > len(field.fields), F.lit(False)) | _any([
            _bind(_unwrapped(F.get(xs, F.lit(k))), partial(_walk_bad, f)) for k, f in enumerate(field.fields)]))
    return _scalar_bad(cell, field.type)


def decode_rows(lines: DataFrame, line: str, fields: list[WireField], json_text: bool = False,
                keep: list[str] | None = None) -> DataFrame:
    """Typed columns of wire lines plus `_decode_error`.

    Unparsable integers and floats become zero, unparsable timestamps the epoch.
    What cannot be read at all becomes null and raises the row's `_decode_error` flag: a bad
    date, datetime or time at any depth, a time outside the calendar, more cells than columns, a list under
    a single column, and a missing or malformed line. JSON
    columns give null unless `json_text` asks for their text.
    """
    keep, text = keep or [], F.col(line)
    skeleton = F.translate(F.regexp_replace("_line", _STRING, "s"), " \t\r\n", "")
    usual = F.coalesce(skeleton.rlike(rf"\A{_shape(fields)}\z"), F.lit(False))
    staged = lines.select(*keep, text.alias("_line"), F.coalesce(text.rlike(_plain_line(fields)), F.lit(False)).alias("_is_plain"))
    staged = staged.select(*keep, "_line", "_is_plain", F.when(F.col("_is_plain"), False).otherwise(usual).alias("_usual"))
    staged = staged.select(
        *keep, "_is_plain", "_usual", F.from_json(F.when(F.col("_is_plain"), _plain_text(F.col("_line"))),
                                                  f"struct<f:array<{_plain_schema(fields)}>>")["f"].alias("_plain"),
        F.from_json(F.when(F.col("_usual"), F.col("_line")), _RECORD)["f"].alias("_cells"),
        F.try_parse_json(F.when(~F.col("_usual") & ~F.col("_is_plain"), F.col("_line"))).alias("_root"))
    staged = staged.select(*keep, "_is_plain", "_usual", "_plain", "_root", _cells(F.col("_root")).alias("_odd"),
                           *[F.get("_cells", F.lit(k))["v"].alias(f"_t{k}") for k in range(len(fields))])
    out, plain_bad, bad, odd_bad = [], [], [], []
    for k, f in enumerate(fields):
        nested = f.type == "RECORD" or f.mode == "REPEATED"
        odd = _unwrapped(_unwrapped(F.get("_odd", F.lit(k)))) if nested else _unwrapped(F.get("_odd", F.lit(k)))
        usual_value = _usual_cell(F.col(f"_t{k}"), f, json_text)
        cell = F.get("_plain", F.lit(k))
        value = F.when(F.col("_is_plain"), _plain_cell(cell, f, json_text)).when(F.col("_usual"), usual_value)
        out.append(value.otherwise(_bind(odd, partial(_walk_as, f, json_text))).alias(f.name))
        flag = _usual_bad(F.col(f"_t{k}"), f)
        if flag is not None:
            bad.append(flag)
            plain_bad.append(_plain_bad(cell, f))
        odd_bad.append(_bind(odd, partial(_walk_bad, f)))
    unread = F.col("_root").isNull() | ~F.schema_of_variant("_root").startswith("OBJECT") | F.coalesce(F.size("_odd") > len(fields), F.lit(False))
    flag = F.when(F.col("_is_plain"), _any(plain_bad)).when(F.col("_usual"), _any(bad)).otherwise(unread | _any(odd_bad))
    return staged.select(*keep, *out, flag.alias("_decode_error"))


def encode_row(*cells: Column) -> Column:
    """Wire line of already encoded cells (strings, arrays or structs under `v`)."""
    return F.to_json(F.struct(F.array(*[F.struct(c.cast("string").alias("v")) for c in cells]).alias("f")),
                     {"ignoreNullFields": "false"})


# ---------------------------------------------------------------- rows by name

def get_column(df: DataFrame, name: str) -> Column:
    """Column of a deduplicated row by name, null when there is none."""
    return F.col(f"`{name}`") if name in df.columns else _null(T.StringType())


def dedupe_columns_last(df: DataFrame) -> DataFrame:
    """One column per name: the last of equal names, kept in the order of those lasts."""
    names = df.columns
    unique = df.toDF(*[f"_{i}" for i in range(len(names))])
    last = {name: i for i, name in enumerate(names)}
    return unique.select(*[F.col(f"_{i}").alias(name) for name, i in sorted(last.items(), key=lambda p: p[1])])
