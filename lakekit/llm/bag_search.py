"""Ranked search for a table of items by scoring each distinct bag of words once.

To the items a document is its count of each of their terms and a length measure m: documents equal in both
score alike everywhere. So documents are restricted to the items' vocabulary (`_vectors`), dealt by a hash of that vector and
m, compared byte by byte within the hash, and each class so verified is scored once. Of a class its `top` smallest ids
are kept, as no other member can be among the `top` results of an item. Tasks keep each item's best classes, by score, then
smallest member: whatever is not among a task's `top` classes is preceded by that many documents. At last the members of the
remaining classes are ranked.

Terms are maximal runs of digits, letters and all signs beyond ASCII, A-Z lower-cased. With N documents that have terms, L terms in
all, df documents holding a term, n terms in a document and tf occurrences: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 100 -
90 + (90 n N) div L, and a score sums w * ((10^9 tf) div (1000 tf + 8 m)) over the item's terms, once each, in 64-bit integers.

Null, empty and wordless texts of either side have no results. Equal scores rank by ascending doc_id, null ids last; repeated
documents are results of their own, repeated items have results of their own. Very long documents are one vector. Empty
tables give no rows. Only the named columns are read. Terms are compared by 64-bit hashes: the odds that any of 10^9 corpus terms
is taken for one of 10^6 item terms are below 10^-4.

What tasks share is bounded: items go in blocks of about BLOCK_TERMS terms, each block searched for itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakekit.llm.arrays import BYTE_VALUES, byte_class, chunks, fold_case, prefix_hash, ragged, span_hash, word_spans
from lakekit.session import cut_lineage, scratch_path

TOP = 10
BLOCK_TERMS = 1 << 19
CELLS = 1 << 22  # entries of the arrays that score a slice of classes
TERM = byte_class(lambda b: b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)
VECTORS = "doc_id bigint, n bigint, vector binary"  # vector: pairs of term number and count, unsigned 32-bit


def _terms(chunk) -> tuple[np.ndarray, np.ndarray]:
    data = fold_case(chunk.data)
    starts, ends, rows = word_spans(chunk, data, TERM)
    return span_hash(prefix_hash(BYTE_VALUES[data]), starts, ends), rows


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            terms, rows = _terms(chunk)
            item = np.repeat(batch.column(0).slice(chunk.lo, chunk.rows).to_numpy(), np.diff(rows))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(terms.view(np.int64))], names=["item", "term"])


def _vectors(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                terms, rows = _terms(chunk)
                at = np.searchsorted(known, terms)
                at[at == len(known)] = 0
                hit = np.flatnonzero(known[at] == terms)
                doc = np.searchsorted(rows, hit, "right") - 1
                key, counts = np.unique(doc * len(known) + at[hit], return_counts=True)
                pairs = np.stack([key % len(known), counts], axis=1).astype(np.uint32)
                ends = np.searchsorted(key // len(known), np.arange(chunk.rows + 1))
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), chunk.rows, [None, pa.py_buffer(8 * ends.astype(np.int64)), pa.py_buffer(pairs)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.lo, chunk.rows), pa.array(np.diff(rows), pa.int64()),
                                                  blobs.cast(pa.binary())], names=["doc_id", "n", "vector"])

    return run


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of all entries of a column of vectors."""
    blobs = column.to_pylist()
    row = np.repeat(np.arange(len(blobs)), [len(b) // 8 for b in blobs])
    pairs = np.frombuffer(b"".join(blobs), np.uint32).reshape(-1, 2).astype(np.int64)
    return row, pairs[:, 0], pairs[:, 1]


def _document_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_pairs(batch.column(0))[1], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["term", "df"])

    return run


class Block:
    """Items of one block: their numbers, and for each term of the vocabulary the places of the items that hold it."""

    def __init__(self, items: np.ndarray, terms: np.ndarray):
        self.vocabulary, term = np.unique(terms, return_inverse=True)
        self.items, item = np.unique(items, return_inverse=True)
        order = np.lexsort((item, term))
        self.held = item[order]
        self.ends = np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))
        self.weights = np.zeros(len(self.vocabulary), np.int64)


def score_classes(block: Block, row: np.ndarray, term: np.ndarray, count: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores of classes (rows) for all items of the block."""
    part = block.weights[term] * (1_000_000_000 * count // (1000 * count + 8 * m[row]))
    degree = np.diff(block.ends)[term]
    cell = np.repeat(row, degree) * len(block.items) + block.held[ragged(block.ends[term], degree)]
    part = np.repeat(part, degree)
    size = len(m) * len(block.items)
    # sums of 20-bit halves are exact in doubles
    high, low = (np.bincount(cell, half.astype(np.float64), size).astype(np.int64) for half in (part >> 20, part & 0xFFFFF))
    return ((high << 20) + low).reshape(len(m), len(block.items))


def _best(item: np.ndarray, score: np.ndarray, first: np.ndarray, top: int) -> np.ndarray:
    """Rows of each item's `top` best by score, then first member."""
    order = np.lexsort((first, -score, item))
    own = item[order]
    return order[np.arange(len(own)) - np.searchsorted(own, own) < top]


def _scorer(shared, top: int):
    schema = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("members", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        degree = np.diff(block.ends)
        floor = np.ones(len(block.items), np.int64)  # a score below is surely not among the best
        empty = np.zeros(0, np.int64)
        held, members = [empty, empty, empty], pa.array([], pa.list_(pa.int64()))

        for batch in batches:
            row, term, count = _pairs(batch.column(0))
            m, lists = batch.column(1).to_numpy(), batch.column(2).cast(pa.list_(pa.int64()))
            first = np.array([NONE if ids[0] is None else ids[0] for ids in lists.to_pylist()], np.int64)
            work = np.cumsum(np.bincount(row, degree[term], len(m)).astype(np.int64) + len(block.items))
            lo = 0
            while lo < len(m):
                done = work[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(work, done + CELLS, "right")))
                a, b = np.searchsorted(row, [lo, hi])
                scores = score_classes(block, row[a:b] - lo, term[a:b], count[a:b], m[lo:hi])
                which, item = np.nonzero(scores >= floor)
                held = [np.concatenate(x) for x in zip(held, (item, scores[which, item], first[lo + which]))]
                members = pa.concat_arrays([members, lists.take(pa.array(lo + which))])
                keep = _best(*held, top)
                held, members = [x[keep] for x in held], members.take(pa.array(keep))
                ends = np.searchsorted(held[0], np.arange(len(floor)), "right")
                full = ends - np.searchsorted(held[0], np.arange(len(floor))) == top
                floor[full] = held[1][ends[full] - 1]
                lo = hi
        yield pa.RecordBatch.from_arrays([pa.array(block.items[held[0]]), pa.array(held[1]), members], schema=schema)

    return run


NONE = (1 << 63) - 1  # stands for a null id, which ranks last


def _search_block(docs: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """(item, doc_id, score) of each item's best documents, for one block of items."""
    spark = docs.sparkSession
    rows = terms.toArrow()  # about BLOCK_TERMS rows
    block = Block(rows["item"].to_numpy(), rows["term"].to_numpy().view(np.uint64))
    size = len(block.vocabulary)
    path = scratch_path(spark, "vectors")
    vocabulary = spark.sparkContext.broadcast(block.vocabulary)
    docs.mapInArrow(_vectors(vocabulary), VECTORS).write.option("compression", "zstd").parquet(path)
    vectors = spark.read.schema(VECTORS).parquet(path)
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = vectors.select("vector").mapInArrow(_document_counts(size), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counts.toArrow().to_pylist():  # the block's vocabulary at most
        block.weights[row["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
    measured = vectors.where("length(vector) > 0").withColumn("m", F.expr(f"10 + (90 * n * {n_docs}) div {max(n_terms, 1)}"))
    keyed = measured.withColumn("key", F.xxhash64("vector", "m"))
    same = W.partitionBy("key", "m", "vector").orderBy(F.col("doc_id").asc_nulls_last())
    first = keyed.withColumn("_rank", F.row_number().over(same)).where(F.col("_rank") <= top)
    ids = F.sort_array(F.collect_list(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")))  # `top` at most
    classes = first.groupBy("key", "m", "vector").agg(F.transform(ids, lambda x: x["doc_id"]).alias("members"))
    shared = spark.sparkContext.broadcast(block)
    scored = classes.select("vector", "m", "members").mapInArrow(_scorer(shared, top), "item bigint, score bigint, members array<bigint>")
    best = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = scored.select("item", "score", F.explode("members").alias("doc_id")).withColumn("rank", F.row_number().over(best))
    return cut_lineage(ranked.where(F.col("rank") <= top).select("item", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per item row and result: item_id, rank (from 1), doc_id, score."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    named = cut_lineage(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
                        .withColumn("item", F.monotonically_increasing_id()))
    terms = cut_lineage(named.select("item", "text").mapInArrow(_item_terms, "item bigint, term bigint").distinct())
    blocks = -(-terms.count() // BLOCK_TERMS)
    dealt = terms.withColumn("_block", F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1))))
    found = [_search_block(plain, dealt.where(F.col("_block") == k).select("item", "term"), top) for k in range(blocks)]
    if not found:
        found = [docs.sparkSession.createDataFrame([], "item bigint, rank int, doc_id bigint, score bigint")]
    return reduce(DataFrame.unionByName, found).join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def oracle_sql(docs: str = "documents", items: str = "benchmark", top: int = TOP) -> str:
    term = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH words AS (SELECT doc_id, {term.format(lower)} AS t FROM {docs}),
    sizes AS (SELECT doc_id, len(t) AS n FROM words WHERE len(t) > 0),
    corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
    asked AS (SELECT DISTINCT item_id, unnest({term.format(lower)}) AS term FROM {items}),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM words)
               WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, corpus GROUP BY term, docs),
    scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
               FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus GROUP BY ALL),
    ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
               FROM scores WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= {top}"""
