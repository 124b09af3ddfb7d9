"""The training-text pipeline: toxicity, near copies, benchmark text, source mix, token files.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Every stage
but the last returns the columns of documents. Rows with a null or empty text pass the filters;
the mix takes tokens, so it drops texts without any. Stages decide by row: ids may be null or
repeat, and doc_id only tells which row of a class of near copies stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm import jaccard_join, mixing, phrase_index, token_files, toxicity
from lakekit.llm.linking import FEW
from lakekit.session import cut_lineage, scratch_path

ROW = "_pipeline_row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labels of this stage's own input."""
    model = toxicity.train_on_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, docs.columns, name="_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).drop("_toxicity")


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a written number of their own under ROW: ids may be null or repeat."""
    path = scratch_path(docs.sparkSession, "numbered")
    rows = docs.withColumn(ROW, F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose number is not among `dropped`; few numbers are broadcast, so the texts stay where they are."""
    dropped = cut_lineage(dropped)
    return rows.join(F.broadcast(dropped) if dropped.count() <= FEW else dropped, ROW, "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least id (rows without an id last) of each class at a Jaccard similarity of 0.8 over five-word shingles, once."""
    rows = _numbered(docs)
    classes = jaccard_join.similar_classes(rows, id_col=ROW).select(F.col("doc_id").alias(ROW), "component_id")
    ranked = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    first = classes.join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(F.min(ranked).alias("first"))
    others = rows.select(ROW).join(first.select(f"first.{ROW}"), ROW, "left_anti")
    return _without(rows, others).select(*docs.columns)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any ten-word window of a benchmark item."""
    rows = _numbered(docs)
    checked = phrase_index.decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW, near=False)
    hit = checked.where("contaminated").select(F.col("doc_id").alias(ROW))
    return _without(rows, hit).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of three fifths of all tokens; a document stands once per epoch, the last of a source cut to its budget."""
    mixed = mixing.mix_documents(docs)
    text = mixing.cut_text(F.col("text"), F.col("take"), F.col("_mix_n"))
    return mixed.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text in Huffman-coded token files, listed as read back."""
    path = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(spark, path).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("benchmark text", drop_benchmark_text),
    ("source mix", mix_sources),
    ("token files", write_token_files),
]

# The classifier and the tokenizer are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
