"""Tokenization of text columns."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: a token is a run of letters or digits of any script.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"

TOKEN_ARRAY = "array<struct<text: string, details: array<string>>>"


def tokenize(df: DataFrame, key: str, text: str,
             analyzer: Callable[[str], list[tuple[str, list[str]]]] | None = None) -> DataFrame:
    """Tokens in order: (key, pos, token, details).

    Without an analyzer tokens are regular-expression matches and `details` is
    empty. An analyzer, such as a dictionary tagger, runs over Arrow batches.
    """
    if analyzer is None:
        words = F.regexp_extract_all(F.col(text), F.lit(TOKEN_PATTERN), F.lit(0))
        return df.select(key, F.posexplode(words).alias("pos", "token")).withColumn(
            "details", F.array().cast("array<string>"))

    @F.pandas_udf(TOKEN_ARRAY)
    def analyze(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"text": w, "details": list(d)} for w, d in analyzer(t)] if t is not None else [])

    return df.select(key, F.posexplode(analyze(F.col(text))).alias("pos", "t")).select(
        key, "pos", F.col("t.text").alias("token"), F.col("t.details").alias("details"))


def token_counts(tokens: DataFrame, *by: str) -> DataFrame:
    return tokens.groupBy(*by, "token").agg(F.count("*").alias("n"))
