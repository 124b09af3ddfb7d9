"""N-gram Jaccard join by partitioning the universe of shingles into segments.

Sizes fall into bands so wide that linked sets stand in the same band or in neighbouring ones.
Linked sets of a band differ in at most H shingles. Hashing cuts the universe into
m = H + 1 + spare segments per band: of linked sets at least m - H parts are equal, as each
differing shingle spoils one segment at most. A set is listed in its own band by all its parts, and in the next band
by those it probes with, as the sets at home there list all of theirs.

Allocation: a set probes with H + 1 parts and passes over the spare ones that would cost most. Empty
parts cost most (half the corpus would match), then the smallest, whose lists are longest.
A set with too few non-empty parts makes up for it with one-deletion neighbourhoods:
it also lists its parts with any one shingle left out, so parts that differ by one
shingle meet. That costs a row per shingle, so a band has as many spare segments as make it rare among its smallest sets. (A set whose shingles crowd into less than half of its needed segments would escape even so; the chance is below 1e-9, as for two hashes being equal.)

Pairs that only share a segment are told apart by parity sketches, whose distance is never more
than that of the sets. Candidates are verified exactly on the shingle sets, and parts that many sets share are never expanded into
all pairs (see `linking`). Sets equal as wholes are one from the start.

Words are runs of other bytes than white space, A-Z lower-cased; shingles are 64-bit hashes
of `width` consecutive words. A text of fewer words is one shingle; null, empty and blank texts
have none and link with nothing. Repeated rows are equal sets, and of equal sets one is listed for all. Rows that share an id count as
one document, linked by any of its texts; rows without an id are in no class (null component). Only the named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrays import BYTE_VALUES, byte_class, chunks, fold_case, mix, prefix_hash, span_hash, word_spans
from lakekit.llm.linking import LEAD, SIGNATURE, equal_nodes, linked_classes, without_nodes
from lakekit.llm.workers import settled
from lakekit.session import scratch_path

WORD = byte_class(lambda b: not (b == 32 or 9 <= b <= 13))
FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)  # one odd factor for each place in a shingle


def shingles(chunk, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within the row, and where rows begin."""
    data = fold_case(chunk.data)
    starts, ends, rows = word_spans(chunk, data, WORD)
    words = span_hash(prefix_hash(BYTE_VALUES[data]), starts, ends)
    counts = np.diff(rows)
    n = len(words) - width + 1
    grams = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        grams += words[k:k + n] * FACTORS[k]
    grams = mix(grams)
    parts = []
    for a, c in zip(rows[:-1].tolist(), counts.tolist()):
        if c >= width:
            parts.append(np.sort(grams[a:a + c - width + 1]))
        elif c:
            parts.append(mix(np.sum(words[a:a + c] * FACTORS[:c], keepdims=True) + np.uint64(c)))
        else:
            parts.append(np.zeros(0, np.uint64))
    sizes = np.array([len(p) for p in parts], np.int64)
    every = np.concatenate([np.zeros(0, np.uint64), *parts])
    row = np.repeat(np.arange(len(parts)), sizes)
    keep = np.ones(len(every), bool)
    if len(every):
        keep[1:] = (every[1:] != every[:-1]) | (row[1:] != row[:-1])
    every, row = every[keep], row[keep]
    return every, np.searchsorted(row, np.arange(len(parts) + 1))


def _sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[rows[1:]] - total[rows[:-1]]


def _keys(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                every, rows = shingles(chunk, width)
                one, two = _sums(mix(every + np.uint64(1)), rows), _sums(mix(every ^ np.uint64(0x5851F42D4C957F2D)), rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.lo, chunk.rows), pa.array(np.diff(rows), pa.int64()),
                    pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names=["doc_id", "n_shingles", "k1", "k2"])

    return run


class Bands:
    """Size bands of a threshold num / den, with their segment counts."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.lows = [1]
        while self.lows[-1] < 1 << 40:
            self.lows.append(-(-self.lows[-1] * den // num))
            if self.lows[-1] == self.lows[-2]:
                self.lows[-1] += 1
        lows = np.array(self.lows, np.int64)
        self.starts = lows[:-1]
        self.apart = 2 * (lows[1:] - 1) * (den - num) // (den + num)  # H: the most shingles linked sets can differ in
        self.segments = self.apart + 2 + self.apart // 24
        least = np.maximum(lows[:-1] * num // den, 1)  # the smallest sets listed in a band
        for step in range(2, 25):
            parts = self.segments.astype(float)
            empty = np.exp(-least / parts)
            spread = np.sqrt(parts * empty * np.maximum(1 - (1 + least / parts) * empty, 0))
            few = parts * (1 - empty) - 2 * spread < self.apart + 1
            self.segments = np.where(few, self.apart + 2 + self.apart * step // 24, self.segments)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, sizes, "right") - 1


@lru_cache(maxsize=8)
def bands_of(num: int, den: int) -> Bands:
    return Bands(num, den)


OWN, PROBE = LEAD, 2


def _signatures(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = bands_of(num, den)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                every, rows = shingles(chunk, width)
                sizes = np.diff(rows)
                ids = batch.column(0).slice(chunk.lo, chunk.rows).to_numpy(zero_copy_only=False).astype(np.int64)
                for role in (0, 1):
                    band = bands.of(np.maximum(sizes, 1)) + role
                    use = (sizes > 0) & (bands.apart[band] > 0) & ((role == 0) | (den * sizes >= num * bands.starts[band]))
                    if use.any():
                        sig, row, flag = _parts(every, rows, use, band, bands, OWN if role == 0 else 0)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(sig.view(np.int64)), pa.array(ids[row]), pa.array((sizes[row] * 4 + flag).astype(np.int64))],
                            names=["sig", "node", "info"])

    return run


def _parts(every, rows, use, band, bands, own):
    """Signatures of the non-empty parts of the used rows, the row of each, and its flags."""
    sizes = np.diff(rows)
    m = np.where(use, bands.segments[band], 0)
    base = np.concatenate([[0], np.cumsum(m)])
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    kept = use[row_of]
    values, row_of = every[kept], row_of[kept]
    segment = ((values >> np.uint64(32)) * m[row_of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    at = base[row_of] + segment
    total = int(base[-1])
    # sums of 32-bit halves are exact in doubles, so this is the 64-bit sum of each part
    scrambled = mix(values ^ np.uint64(0x9FB21C651E98DF25))
    low = np.bincount(at, (scrambled & np.uint64(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
    high = np.bincount(at, (scrambled >> np.uint64(32)).astype(np.float64), total).astype(np.uint64)
    count = np.bincount(at, minlength=total)
    part_sum = low + (high << np.uint64(32))
    owner = np.repeat(np.arange(len(sizes)), m)
    place = mix((band[owner].astype(np.uint64) << np.uint64(40)) + (np.arange(total) - base[owner]).astype(np.uint64))
    filled = count > 0
    have = np.bincount(owner[filled], minlength=len(sizes))
    need = bands.apart[band] + 1
    # the spare parts, smallest first, don't probe
    listed = np.flatnonzero(filled)
    order = np.argsort((owner[listed] << 20) + np.minimum(count[listed], (1 << 20) - 1), kind="stable")
    listed = listed[order]
    first = np.cumsum(have) - have
    rank = np.arange(len(listed)) - first[owner[listed]]
    flag = np.where(rank < (have - need)[owner[listed]], 0, PROBE) + own
    if not own:
        listed, flag = listed[flag == PROBE], flag[flag == PROBE]
    sig, row = [mix(part_sum[listed] ^ place[listed])], [owner[listed]]
    flags = [flag]
    short = use & (have < need)
    if short.any():
        fewer = short[row_of]
        sig.append(mix((part_sum[at[fewer]] - scrambled[fewer]) ^ place[at[fewer]]))
        row.append(row_of[fewer])
        flags.append(np.full(int(fewer.sum()), PROBE + own))
    return np.concatenate(sig), np.concatenate(row), np.concatenate(flags)


def _verify(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[], []]
            for side in (0, 1):
                for chunk in chunks(batch.column(2 + side)):
                    every, rows = shingles(chunk, width)
                    sets[side] += [every[a:b] for a, b in zip(rows[:-1], rows[1:])]
            good = []
            for one, two in zip(*sets):
                if len(one) > len(two):
                    one, two = two, one
                at = np.searchsorted(two, one)
                at[at == len(two)] = 0
                both = int((two[at] == one).sum()) if len(two) else 0
                good.append(both > 0 and den * both >= num * (len(one) + len(two) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return run


SKETCH_WORDS = 16


def _sketches(width: int):
    """Parity of the shingles in each of 1,024 hash classes: two sets differ in at least as many shingles as bits."""
    bits, step = SKETCH_WORDS * 64, 2048

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                every, rows = shingles(chunk, width)
                for lo in range(0, chunk.rows, step):
                    hi = min(lo + step, chunk.rows)
                    own = every[rows[lo]:rows[hi]]
                    place = np.repeat(np.arange(hi - lo), np.diff(rows[lo:hi + 1])) * bits + (own >> np.uint64(54)).astype(np.int64)
                    odd = (np.bincount(place, minlength=(hi - lo) * bits) & 1).astype(np.uint8)
                    packed = np.packbits(odd).view(np.int64).reshape(hi - lo, SKETCH_WORDS)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(chunk.lo + lo, hi - lo), *(pa.array(packed[:, k].copy()) for k in range(SKETCH_WORDS))],
                        names=["node", *(f"s{k}" for k in range(SKETCH_WORDS))])

    return run


def similar_classes(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable over links of Jaccard >= num / den)."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema, path = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint", scratch_path(spark, "set-keys")
    plain.mapInArrow(settled(_keys(width)), schema).write.parquet(path)
    keys = spark.read.schema(schema).parquet(path)
    filled = keys.where("n_shingles > 0 and doc_id is not null").withColumnRenamed("doc_id", "node")
    known = plain.where("doc_id is not null").withColumnRenamed("doc_id", "node")

    def valid(a: str, b: str) -> str:
        return (f"(({a} | {b}) & {PROBE}) <> 0 and (({a} | {b}) & {OWN}) <> 0"
                f" and {den} * least({a} >> 2, {b} >> 2) >= {num} * greatest({a} >> 2, {b} >> 2)")

    def close(u: str, v: str) -> str:
        differ = " + ".join(f"bit_count({u}.s{k} ^ {v}.s{k})" for k in range(SKETCH_WORDS))
        return f"({differ}) * {den + num} <= (({u}.info >> 2) + ({v}.info >> 2)) * {den - num}"

    copies = equal_nodes(filled, ["n_shingles", "k1", "k2"])
    several = filled.groupBy("node").count().where("count > 1")  # ids with texts of their own beside an equal one
    listed = without_nodes(known, copies.join(several, "node", "left_anti").select("node"))
    roots = linked_classes(copies, listed.mapInArrow(settled(_signatures(width, num, den)), SIGNATURE), known, _verify(width, num, den), valid,
                           _sketches(width), SKETCH_WORDS, close)
    roots = roots.select(F.col("node").alias("doc_id"), F.col("root").alias("component_id"))
    linked = keys.where("doc_id is not null").join(roots, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = keys.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    return linked.unionByName(nameless)
