"""Scalar functions as Column expressions; everything stays in code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakekit.functions import fixed_values as fixed


def lookup(col: Column, mapping: dict, default=None) -> Column:
    """Map a column through a small fixed dictionary; unmatched and null give `default`."""
    out = None
    for key, value in mapping.items():
        out = F.when(col == F.lit(key), F.lit(value)) if out is None else out.when(col == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def cpow(base: Column, expo: Column) -> Column:
    """Power with C semantics: 1**x is 1 and (-1)**±inf is 1; null if either side is null."""
    return (
        F.when(base.isNull() | expo.isNull(), F.lit(None).cast("double"))
        .when(base == 1, F.lit(1.0))
        .when((base == -1) & (F.abs(expo) == float("inf")), F.lit(1.0))
        .otherwise(F.pow(base, expo))
    )


def int_div(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero, whatever `/` means in the dialect."""
    return F.call_function("div", a, b)


def date_bin(ts: Column, seconds: int) -> Column:
    """Start of the fixed-width bin of a timestamp, counted from the epoch."""
    micros = seconds * 1_000_000
    shifted = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(shifted - F.pmod(shifted, F.lit(micros)))


def base64_text(body: Column) -> Column:
    """Base64 on one line, whatever line length the encoder uses."""
    return F.translate(F.base64(body), "\r\n", "")


# ---------------------------------------------------------------- objects and mime types

def object_url(bucket: Column, name: Column) -> Column:
    return F.concat(F.lit("gs://"), bucket, F.lit("/"), F.coalesce(name, F.lit("")))


def mime_normalize(content_type: Column) -> Column:
    """Keep a well-formed content type, replace a malformed one, leave null alone."""
    return F.when(content_type.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(content_type.rlike(fixed.MIME_PATTERN), content_type).otherwise(F.lit(fixed.OCTET_STREAM)))


def mime_guess(path: Column, default: str = fixed.OCTET_STREAM) -> Column:
    """Mime type from the extension of the last path segment."""
    extension = F.lower(F.regexp_extract(path, r"[^/]\.([A-Za-z0-9]+)$", 1))
    table = F.create_map(*[F.lit(x) for pair in fixed.MIME_BY_EXTENSION.items() for x in pair])  # folded to one literal
    return F.coalesce(F.try_element_at(table, extension), F.lit(default))


def prefix_normalize(prefix: Column) -> Column:
    """Strip exactly one leading slash."""
    return F.regexp_replace(prefix, "^/", "")


_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def split_object_url(text: Column) -> Column:
    """Struct (bucket, path) of an object URL; a plain name is a bucket without a path."""
    is_url = text.rlike(_URL)
    return F.struct(
        F.when(is_url, F.regexp_extract(text, _URL, 1)).otherwise(text).alias("bucket"),
        F.when(is_url, prefix_normalize(F.regexp_extract(text, _URL, 2))).otherwise(F.lit("")).alias("path"),
    )


# ---------------------------------------------------------------- names and classes

def parse_resource_name(name: Column, kind: str) -> Column:
    """Struct of the name's parts plus is_valid; parts are null when the name does not match.

    One match per row: the groups are rewritten around a separator and split.
    """
    fields = {"service": ["project", "location", "service_name"],
              "job": ["project", "location", "job_name"],
              "execution": ["project", "location", "job_name", "execution_name"]}[kind]
    whole = r"(?s:^.*?)" + fixed.RESOURCE_PATTERNS[kind] + r"(?s:.*)$"
    groups = "\u0001".join(f"${i}" for i in range(1, len(fields) + 1))
    parts = F.split(F.regexp_replace(name, whole, groups), "\u0001")
    valid = F.coalesce(F.size(parts) == len(fields), F.lit(False))
    return F.struct(*[F.when(valid, F.get(parts, F.lit(i))).alias(f) for i, f in enumerate(fields)],
                    valid.alias("is_valid"))


def location_path(project: Column, location: Column) -> Column:
    return F.concat(F.lit("projects/"), project, F.lit("/locations/"), location)


def service_name(project: Column, location: Column, service: Column) -> Column:
    return F.concat(location_path(project, location), F.lit("/services/"), service)


def job_name(project: Column, location: Column, job: Column) -> Column:
    return F.concat(location_path(project, location), F.lit("/jobs/"), job)


def execution_name(project: Column, location: Column, job: Column, execution: Column) -> Column:
    return F.concat(job_name(project, location, job), F.lit("/executions/"), execution)


def job_status(status: Column) -> Column:
    return lookup(status, fixed.JOB_STATUS, fixed.JOB_STATUS_DEFAULT)


def condition_type(text: Column) -> Column:
    return lookup(text, fixed.CONDITION_TYPE, fixed.CONDITION_TYPE_DEFAULT)


def condition_state(text: Column) -> Column:
    return lookup(text, fixed.CONDITION_STATE, fixed.CONDITION_STATE_DEFAULT)


ERROR_SCHEMA = (
    "error STRUCT<code: INT, message: STRING, "
    "errors: ARRAY<STRUCT<domain: STRING, message: STRING, reason: STRING>>>"
)


def classify_error(body: Column) -> Column:
    """Struct (kind, code, message) of an API error body."""
    error = F.from_json(body, ERROR_SCHEMA)["error"]
    code = F.coalesce(error["code"], F.lit(fixed.ERROR_CODE_DEFAULT))
    return F.struct(
        lookup(code, fixed.ERROR_KIND, fixed.ERROR_KIND_DEFAULT).alias("kind"),
        code.alias("code"),
        F.coalesce(error["message"], F.lit(fixed.ERROR_MESSAGE_DEFAULT)).alias("message"),
    )


def model_publisher(model: Column) -> Column:
    out = None
    for prefix, publisher in fixed.MODEL_PUBLISHER.items():
        hit = model.startswith(prefix)
        out = F.when(hit, F.lit(publisher)) if out is None else out.when(hit, F.lit(publisher))
    return out.otherwise(F.lit(fixed.MODEL_PUBLISHER_DEFAULT))


def model_path(project: Column, location: Column, model: Column) -> Column:
    return F.concat(location_path(project, location), F.lit("/publishers/"), model_publisher(model),
                    F.lit("/models/"), model)


def topic_path(project: Column, topic: Column) -> Column:
    return F.concat(F.lit("projects/"), project, F.lit("/topics/"), topic)


def subscription_path(project: Column, subscription: Column) -> Column:
    return F.concat(F.lit("projects/"), project, F.lit("/subscriptions/"), subscription)
