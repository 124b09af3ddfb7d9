"""Model requests and responses as DataFrame jobs around an external call."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.functions import fixed_values as fixed
from lakekit.functions.scalars import base64_text, mime_guess

RESPONSE = (
    "candidates ARRAY<STRUCT<content: STRUCT<parts: ARRAY<STRUCT<text: STRING>>>>>, "
    "usageMetadata STRUCT<promptTokenCount: INT, candidatesTokenCount: INT, totalTokenCount: INT>"
)
PREDICTIONS = (
    "predictions ARRAY<STRUCT<embeddings: STRUCT<statistics: STRUCT<token_count: INT, truncated: BOOLEAN>, "
    "values: ARRAY<FLOAT>>>>"
)


def text_part(text: Column) -> Column:
    return F.to_json(F.struct(text.alias("text")))


def file_part(uri: Column) -> Column:
    """A file by URI; its mime type comes from the extension, text/plain when unknown."""
    return F.to_json(F.struct(F.struct(
        uri.alias("fileUri"), mime_guess(uri, fixed.TEXT_PLAIN).alias("mimeType")).alias("fileData")))


def inline_part(body: Column, mime_type: Column) -> Column:
    return F.to_json(F.struct(F.struct(
        base64_text(body).alias("data"), mime_type.alias("mimeType")).alias("inlineData")))


def content_request(*parts: Column) -> Column:
    """Request body: one `user` content holding the given parts, null parts left out."""
    return F.concat(F.lit('{"contents":[{"role":"user","parts":['), F.concat_ws(",", *parts), F.lit("]}]}"))


def embed_request(content: Column, task_type: Column) -> Column:
    """Embedding instance; a task type outside the known eight is refused."""
    known = task_type.isNull() | task_type.isin(*fixed.EMBED_TASK_TYPES)
    checked = F.when(known, task_type).otherwise(
        F.raise_error(F.concat(F.lit("unknown task type: "), task_type)).cast("string"))
    return F.concat(
        F.lit('{"instances":['),
        F.to_json(F.struct(content.alias("content"), checked.alias("task_type")), {"ignoreNullFields": "false"}),
        F.lit("]}"))


def _token_info(model: Column, prompt: Column, completion: Column, total: Column) -> Column:
    return F.struct(model.alias("model_name"), prompt.alias("prompt_tokens"),
                    completion.alias("completion_tokens"), total.alias("total_tokens"))


def decode_content(responses: DataFrame, body: str, model: str, keep: list[str] | None = None) -> DataFrame:
    """First text of the first candidate (null when there is none) and the token counts."""
    keep = keep or []
    r, usage = F.col("_r"), F.col("_r")["usageMetadata"]
    first = F.get(F.get(r["candidates"], F.lit(0))["content"]["parts"], F.lit(0))["text"]
    return responses.select(*keep, F.col(model), F.from_json(F.col(body), RESPONSE).alias("_r")).select(
        *keep, first.alias("text"),
        F.when(first.isNotNull(), "Text").otherwise("None").alias("result"),
        _token_info(F.col(model), usage["promptTokenCount"], usage["candidatesTokenCount"],
                    usage["totalTokenCount"]).alias("token_info"))


def decode_embeddings(responses: DataFrame, body: str, model: str, keep: list[str] | None = None) -> DataFrame:
    """Vector and token counts of the first prediction; `error` is set when there is none."""
    keep = keep or []
    r = F.col("_r")
    first = F.get(r["predictions"], F.lit(0))["embeddings"]
    count = first["statistics"]["token_count"]
    return responses.select(*keep, F.col(model), F.from_json(F.col(body), PREDICTIONS).alias("_r")).select(
        *keep, first["values"].alias("embeddings"),
        F.when(first.isNull(), F.lit("no predictions")).alias("error"),
        _token_info(F.col(model), count, F.when(first.isNotNull(), 0), count).alias("token_info"))


def token_usage(decoded: DataFrame) -> DataFrame:
    """Calls and token sums per model."""
    info = F.col("token_info")
    return decoded.groupBy(info["model_name"].alias("model_name")).agg(
        F.count("*").alias("calls"),
        F.sum(info["prompt_tokens"].cast("long")).alias("prompt_tokens"),
        F.sum(info["completion_tokens"].cast("long")).alias("completion_tokens"),
        F.sum(info["total_tokens"].cast("long")).alias("total_tokens"))


def call_model(requests: DataFrame, request: str, client: Callable[[], Callable[[str], str]],
               response: str = "response") -> DataFrame:
    """Send each request body through a client built once per partition; batches stream through."""
    schema = T.StructType([*requests.schema.fields, T.StructField(response, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = client()
        for batch in batches:
            batch[response] = [send(body) for body in batch[request]]
            yield batch

    return requests.mapInPandas(run, schema)
