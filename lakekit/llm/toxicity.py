"""Toxicity: a character n-gram linear classifier on naive Bayes log-count ratios.

Training takes at most SAMPLE labels of each class, chosen by a hash of the id; that bound is the
only sample. The log-count ratio of every hashed n-gram comes from their counts, added up by
Spark. The FEATURES n-grams that tell the classes apart best are kept, and a logistic regression
is fitted on their presence, scaled by the ratios. Scoring reads every whole text.

An n-gram is 4 or 5 code points of the text with A-Z lower-cased and every run of other characters
than letters and digits as one space. Text labels are 0 or 1; rows with a null label, id
or text don't train. Null and empty texts have no n-grams: they score the bias alone. A
document with several labels trains once for each. Without rows of both classes the
model scores every text 0. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.llm.arrays import BYTE_VALUES, byte_class, chunks, fold_case, mix, powers
from lakekit.llm.workers import settled
from lakekit.session import scratch_path

SIZES = (4, 5)
BUCKETS = 1 << 20
FEATURES = 2048
SAMPLE = 8_000
MIN_DOCS = 4
THRESHOLD = 0.7
_PLAIN = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def _grams(chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram of the chunk and the row it stands in."""
    data = fold_case(chunk.data)
    plain = _PLAIN[data]
    row = np.repeat(np.arange(chunk.rows, dtype=np.int32), chunk.lengths)
    keep = plain.copy()
    if len(data):
        keep[1:] |= plain[:-1] | (row[1:] != row[:-1])
        keep[0] = True
    data, row = np.where(plain, data, 32).astype(np.uint8)[keep], row[keep]
    lead = (data & 0xC0) != 0x80  # a code point's first byte
    at = np.flatnonzero(lead)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=prefix[1:])
    inverse, bounds = powers(len(data) + 1, inverse=True), np.append(at, len(data))
    hashes, rows = [], []
    for size in SIZES:
        n = len(at) - size + 1
        if n <= 0:
            continue
        start, last, end = bounds[:n], bounds[size - 1:size - 1 + n], bounds[size:size + n]
        whole = row[start] == row[last]
        start, end = start[whole], end[whole]
        value = mix((prefix[end] - prefix[start]) * inverse[start] + np.uint64(size))
        hashes.append((value >> np.uint64(44)).astype(np.int32))
        rows.append(row[start])
    if not hashes:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(hashes), np.concatenate(rows)


def _present(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram once per row."""
    key = np.unique(rows.astype(np.int64) * BUCKETS + hashes)
    return (key % BUCKETS).astype(np.int32), (key // BUCKETS).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), np.int64)
    seen = np.zeros(2, np.int64)
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        seen += np.bincount(labels, minlength=2)
        for chunk in chunks(batch.column(0)):
            grams, rows = _present(*_grams(chunk))
            label = labels[chunk.lo + rows]
            for k in (0, 1):
                total[k] += np.bincount(grams[label == k], minlength=BUCKETS)
    keep = np.flatnonzero(total.sum(axis=0))
    yield pa.RecordBatch.from_arrays([
        pa.array(np.append(keep, -1), pa.int32()), pa.array(np.append(total[0][keep], seen[0]), pa.int64()),
        pa.array(np.append(total[1][keep], seen[1]), pa.int64())], names=["gram", "n0", "n1"])


@dataclass
class Model:
    """Sorted gram buckets with their weights, and the bias."""

    grams: np.ndarray
    weights: np.ndarray
    bias: float


def _sparse_rows(model_grams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_grams.value, np.arange(len(model_grams.value)) + 1)
        for batch in batches:
            found = []
            for chunk in chunks(batch.column(0)):
                hashes, rows = _grams(chunk)
                at = table[hashes].astype(np.int64)
                hashes, rows = _present(at[at > 0], rows[at > 0])
                found += [x.tolist() for x in np.split(hashes - 1, np.searchsorted(rows, np.arange(1, chunk.rows)))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1).cast(pa.int32())],
                                             names=["features", "label"])

    return run


def _table(grams: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(BUCKETS, values.dtype)
    out[grams] = values
    return out


def _fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, rounds: int = 150, penalty: float = 1e-3):
    """Logistic regression by accelerated full-batch descent; classes weigh the same."""
    index = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    scale = ratio[index]
    curve = np.bincount(owner, scale * scale, len(rows)).max(initial=1.0) / 4 + 1  # bounds the curvature
    w, bias, v, vb = np.zeros(len(ratio)), 0.0, np.zeros(len(ratio)), 0.0
    for k in range(rounds):
        x, xb = w + k / (k + 3) * v, bias + k / (k + 3) * vb
        z = np.bincount(owner, scale * x[index], len(rows)) + xb
        slope = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        grad = np.bincount(index, scale * slope[owner], len(ratio)) + penalty * x
        new, nb = x - grad / curve * 4, xb - slope.sum() / curve * 4
        v, vb, w, bias = new - w, nb - bias, new, nb
    return w, bias


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "label", features: int = FEATURES) -> Model:
    """Fit on labelled rows; the caller bounds their number, as their features meet on the driver."""
    spark, path = labelled.sparkSession, scratch_path(labelled.sparkSession, "labelled")
    rows = labelled.where(F.col(label_col).isin(0, 1) & F.col(text_col).isNotNull())
    rows.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).write.parquet(path)
    rows = spark.read.schema("text string, label int").parquet(path)
    counted = rows.mapInArrow(settled(_count), "gram int, n0 bigint, n1 bigint").groupBy("gram").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    seen = counted.where("gram = -1").first()
    if seen is None or not seen["n0"] or not seen["n1"]:
        return Model(np.zeros(0, np.int32), np.zeros(0), -30.0)
    n0, n1 = float(seen["n0"]), float(seen["n1"])
    ratio = F.log((F.col("n1") + 1) / F.lit(n1 + 2)) - F.log((F.col("n0") + 1) / F.lit(n0 + 2))
    # how far the class shares differ, in standard errors: rare n-grams rank below telling ones
    share = (F.col("n0") + F.col("n1") + 1) / F.lit(n0 + n1 + 2)
    gap = F.abs(F.col("n1") / n1 - F.col("n0") / n0) / F.sqrt(share * (1.000001 - share))
    best = counted.where((F.col("gram") >= 0) & (F.col("n0") + F.col("n1") >= MIN_DOCS)).select(
        "gram", ratio.alias("ratio"), gap.alias("gap")).orderBy(F.desc("gap"), "gram").limit(features).collect()
    best.sort(key=lambda r: r["gram"])
    grams, ratios = np.array([r["gram"] for r in best], np.int32), np.array([r["ratio"] for r in best])
    drawn = rows.mapInArrow(settled(_sparse_rows(spark.sparkContext.broadcast(grams))), "features array<int>, label int").toArrow()
    lists = drawn.column("features").combine_chunks()
    values, cuts = lists.flatten().to_numpy(), np.cumsum(np.diff(lists.offsets.to_numpy()))
    w, bias = _fit(np.split(values, cuts[:-1]), drawn.column("label").to_numpy().astype(np.float64), ratios)
    return Model(grams, w * ratios, bias)


def _scorer(model, text_at: int, kept: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        place = _table(fitted.grams, np.arange(len(fitted.grams)) + 1)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for chunk in chunks(batch.column(text_at)):
                hashes, rows = _grams(chunk)
                at = place[hashes].astype(np.int64)
                grams, rows = _present(at[at > 0], rows[at > 0])
                z = np.bincount(rows, fitted.weights[grams - 1], chunk.rows) + fitted.bias
                scores[chunk.lo:chunk.hi] = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names[:kept], name])

    return run


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """The `keep` columns of every row with its score in 0..1 under `name`, which must not be one of them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights
    columns = keep if text_col in keep else [*keep, text_col]
    plain = docs.select(*(F.col("`" + c.replace("`", "``") + "`") for c in columns))
    schema = T.StructType([*plain.schema.fields[:len(keep)], T.StructField(name, T.DoubleType())])
    return plain.mapInArrow(settled(_scorer(shared, columns.index(text_col), len(keep), name)), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: the crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_on_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the documents' `toxic` labels outside the held-out third, `sample` labels of each class at most."""
    marks = labels.select("doc_id", F.col("toxic").alias("label")).where(~held_out() & F.col("doc_id").isNotNull())
    drawn = None
    for label in (0, 1):
        own = marks.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        drawn = own if drawn is None else drawn.union(own)
    # at most 2 * sample rows of two numbers
    return train(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"))
