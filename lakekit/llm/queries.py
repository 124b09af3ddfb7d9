"""Registered queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm import (bag_search, bm25, jaccard_join, line_join, mixing, packing, page_diff, phrase_index, secret_scan, spelling,
                         suffix_dedup, token_files, toxicity)

QUERIES, ORACLES = {}, {}


def _query(key: str, oracle: str | None = None):
    def wrap(run):
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return run

    return wrap


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_mix", mixing.oracle_sql())
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", *(F.col(k).alias(c) for k, c in zip(mixing.LEVELS, ("domain", "lang", "source"))), "epoch", "take")


@_query("op2_page_diff")
def op2_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_shared")


@_query("op3_bm25")
def op3_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for the whole text of every document whose id is divisible by 50."""
    docs = table(spark, sf_dir, "documents")
    return bm25.search(docs, docs.where("doc_id % 50 = 0")).withColumn("score", F.round("score", 6))


@_query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@_query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_classes(table(spark, sf_dir, "documents"), width=4, num=85, den=100)


@_query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated", "n_near")


@_query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(spark, path, ids=False)


@_query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("runs").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@_query("op9_line_join")
def op9_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_join.drop_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train_on_labels(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.withColumn("held_out", toxicity.held_out()), model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@_query("op11_bag_search", bag_search.oracle_sql())
def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op12_spelling")
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


@_query("op13_packing")
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
