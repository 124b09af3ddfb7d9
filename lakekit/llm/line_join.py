"""Line dedup: an edit-distance join of lines by segment partition.

A line of n characters is cut into LIMIT + 1 segments of even length. Lines within LIMIT edits
share at least one segment, at places that differ by no more than the edits around it allow. Every line is
listed by its own segments, under its length and the segment's number, and probes, for each length down to
n - LIMIT, with the substrings a shared segment could have become. Substrings are hashed
in constant time from running hashes. Candidates are verified by a banded bit-parallel edit distance.
Equal lines are one from the start: a line goes by a 64-bit hash of its bytes, which is
chosen anew if two different lines share it, by a second hash and their sizes. Before lines of one bucket are paired, parities of their
character pairs must be as near as the limit asks. Lines linked directly or through others form a class (see `linking`: a
segment that many lines share is not expanded into all pairs).

Of each class the first line by (doc_id, line number) stays, wherever the others stand.
Lines are parted by line feeds and counted in code points. Lines shorter than SHORT characters link only to
equal ones; lines of spaces alone always stay. A null text has no lines, an empty one a single blank line. Repeated rows are documents of
their own; the copy whose row was read first keeps its lines. Null ids come first. Only the named columns are read.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrays import BYTE_VALUES, byte_view, chunks, mix, prefix_hash, ragged, span_hash
from lakekit.llm.linking import LEAD, SIGNATURE, linked_classes, stored
from lakekit.session import discard, scratch_path

LIMIT = 2
SHORT = 20
SEEN = 200_000  # lines a task remembers; one listed twice costs rows, which are made one later
INDEX, PROBE = LEAD, 2
SKETCH_WORDS = 4
BASE = "rid bigint, doc_id bigint, text string"
LINES = "node bigint, rid bigint, doc_id bigint, line int, h2 bigint, size int"


def line_values(salt: int) -> np.ndarray:
    """Values of the bytes for the hash that lines go by."""
    return mix(BYTE_VALUES + np.uint64(salt)) if salt else BYTE_VALUES


def _split(batch: pa.RecordBatch):
    """For each chunk of a base batch: (chunk, row, line, start, end, size in code points) of its lines."""
    valid = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
    for chunk in chunks(batch.column(2)):
        data = chunk.data
        feed = np.flatnonzero(data == 10)
        rows = np.concatenate([np.arange(chunk.rows), np.searchsorted(chunk.offsets, feed, "right") - 1])
        starts = np.concatenate([chunk.offsets[:-1], feed + 1])
        order = np.lexsort((starts, rows))
        rows, starts = rows[order], starts[order]
        ends = np.append(starts[1:] - 1, 0)
        last = np.append(rows[1:] != rows[:-1], True)
        ends[last] = chunk.offsets[rows[last] + 1]
        keep = valid[chunk.lo + rows]
        rows, starts, ends = rows[keep], starts[keep], ends[keep]
        line = np.arange(len(rows)) - np.searchsorted(rows, rows)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        yield chunk, rows, line, starts, ends, lead[ends] - lead[starts]


def _blank(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    solid = np.concatenate([[0], np.cumsum(data != 32)])
    return solid[ends] == solid[starts]


def _lines(values: np.ndarray):
    """Hashes of the lines that are not blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = mix(BYTE_VALUES + np.uint64(1))
        for batch in batches:
            for chunk, rows, line, starts, ends, size in _split(batch):
                use = ~_blank(chunk.data, starts, ends)
                own = [batch.column(i).slice(chunk.lo, chunk.rows).take(pa.array(rows[use])) for i in (0, 1)]
                node, h2 = (span_hash(prefix_hash(v[chunk.data]), starts[use], ends[use]).view(np.int64) for v in (values, other))
                yield pa.RecordBatch.from_arrays([
                    pa.array(node), *own, pa.array(line[use].astype(np.int32)), pa.array(h2),
                    pa.array(size[use].astype(np.int32))], names=["node", "rid", "doc_id", "line", "h2", "size"])

    return run


def _texts(least: int, values: np.ndarray):
    """Texts of the lines of at least that size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, _, _, starts, ends, size in _split(batch):
                use = (size >= least) & ~_blank(chunk.data, starts, ends)
                node = span_hash(prefix_hash(values[chunk.data]), starts[use], ends[use]).view(np.int64)
                starts, sizes = starts[use], (ends - starts)[use]
                texts = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                                                    pa.py_buffer(chunk.data[ragged(starts, sizes)]))
                yield pa.RecordBatch.from_arrays([pa.array(node), texts], names=["node", "text"])

    return run


def segments(size: np.ndarray, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, length) of the limit + 1 segments of lines of these sizes; the longer ones stand last."""
    base, longer = size // (limit + 1), size % (limit + 1)
    out = []
    for i in range(limit + 1):
        extra = np.maximum(i - (limit + 1 - longer), 0)
        out.append((i * base + extra, base + (i >= limit + 1 - longer)))
    return out


def probes(size: np.ndarray, limit: int):
    """(segment number, listed size, start, length, valid) of every substring a line of `size` probes with."""
    for apart in range(limit + 1):
        listed = size - apart
        for i, (start, length) in enumerate(segments(listed, limit)):
            # with i segments before it and limit - i after it, a shared segment that moves further leaves
            # another one shared on that side
            low = np.maximum.reduce([start - i, start + apart - (limit - i), np.zeros_like(start)])
            high = np.minimum.reduce([start + i, start + apart + (limit - i), size - length])
            for step in range(limit * 2 + 1):
                yield i, listed, low + step, length, low + step <= high


def _signatures(limit: int, least: int, values: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # lines this task has listed: an equal line needs no list of its own
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            for chunk, _, _, starts, ends, size in _split(batch):
                # running hashes over code points: one entry per lead byte
                lead = np.flatnonzero((chunk.data & 0xC0) != 0x80)
                bounds = np.append(lead, len(chunk.data))
                prefix = prefix_hash(values[chunk.data])
                use = np.flatnonzero((size >= least) & ~_blank(chunk.data, starts, ends))
                node = span_hash(prefix, starts[use], ends[use]).view(np.int64)
                fresh = np.array([h not in seen and not seen.add(h) for h in node.tolist()], bool)
                use, node = use[fresh], node[fresh]
                if not len(use):
                    continue
                first, size = np.searchsorted(lead, starts[use]), size[use]

                def rows(i, listed, start, length, flag, ok):
                    a, b = first[ok] + start[ok], first[ok] + start[ok] + length[ok]
                    place = mix(listed[ok].astype(np.uint64) * np.uint64(64) + np.uint64(i))
                    sig = mix(span_hash(prefix, bounds[a], bounds[b]) ^ place)
                    return pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(node[ok]), pa.array(np.full(len(a), flag))],
                                                      names=["sig", "node", "info"])

                whole, own = np.ones(len(node), bool), segments(size, limit)
                for i, (start, length) in enumerate(own):
                    yield rows(i, size, start, length, INDEX | PROBE, whole)  # a line also probes with its own segments
                for i, listed, start, length, ok in probes(size, limit):
                    ok = ok & (listed >= least) & ((listed != size) | (start != own[i][0]))
                    if ok.any():
                        yield rows(i, listed, start, length, PROBE, ok)

    return run


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parity of the character pairs in each hash class: an edit changes four at most."""
    bits, step = SKETCH_WORDS * 64, 2048
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            texts = [t.encode("utf-32-le") for t in part.column(1).to_pylist()]
            ends = np.cumsum([len(t) // 4 for t in texts])
            points = np.frombuffer(b"".join(texts), "<u4").astype(np.uint64)
            row = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
            inside = row[1:] == row[:-1]
            pair = mix((points[:-1] << np.uint64(32) | points[1:])[inside] + np.uint64(1)) % np.uint64(bits)
            odd = (np.bincount(row[1:][inside] * bits + pair.astype(np.int64), minlength=len(texts) * bits) & 1).astype(np.uint8)
            packed = np.packbits(odd).view(np.int64).reshape(len(texts), SKETCH_WORDS)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(packed[:, k].copy()) for k in range(SKETCH_WORDS))],
                                             names=["node", *(f"s{k}" for k in range(SKETCH_WORDS))])


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance is at most `limit`: bit-parallel columns over a band of 2 * limit + 1 diagonals."""
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if m - n > limit:
        return False
    head = 0
    while head < n and a[head] == b[head]:
        head += 1
    while n > head and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = a[head:n], b[head:m]
    if not a:
        return len(b) <= limit
    # bit d of reach[e]: with e edits, the diagonal (place in b) - (place in a) = d - limit can be at this column
    width = 2 * limit + 1
    full = (1 << width) - 1
    masks: dict[str, int] = {}
    for j in range(min(limit + 1, len(b))):
        masks[b[j]] = masks.get(b[j], 0) | 1 << (j + limit)
    reach = [0] * (limit + 1)
    for e in range(limit + 1):
        reach[e] = ((1 << (e + 1)) - 1) << limit & full  # insertions before the first character of a
    for i, x in enumerate(a):
        # masks holds, for the characters of b at i - limit .. i + limit, their diagonals
        equal = masks.get(x, 0)
        before = reach
        reach = []
        for e in range(limit + 1):
            now = before[e] & equal
            if e:
                now |= before[e - 1] | before[e - 1] >> 1  # replace, or drop a character of a
                now |= reach[e - 1] << 1 & full  # take a character of b
            reach.append(now)
        shifted = {}
        for c, bits in masks.items():
            if bits >> 1:
                shifted[c] = bits >> 1
        nxt = i + 1 + limit
        if nxt < len(b):
            shifted[b[nxt]] = shifted.get(b[nxt], 0) | 1 << 2 * limit
        masks = shifted
        if not any(reach):
            return False
    goal = 1 << (len(b) - len(a) + limit)
    return any(bits & goal for bits in reach)


def _verify(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([within(a, b, limit) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return run


def drop_lines(docs: DataFrame, limit: int = LIMIT, short: int = SHORT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, kept (the text without the removed lines, null for a null text)."""
    spark, least = docs.sparkSession, max(short, limit + 1)
    base_path, gone_path = (scratch_path(spark, n) for n in ("line-rows", "gone-lines"))
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    numbered.write.option("compression", "zstd").parquet(base_path)
    base = spark.read.schema(BASE).parquet(base_path)
    for salt in count():
        values, line_path = line_values(salt), scratch_path(spark, "lines")
        base.mapInArrow(_lines(values), LINES).write.option("compression", "zstd").parquet(line_path)
        lines = spark.read.schema(LINES).parquet(line_path)
        repeated = lines.groupBy("node").agg(F.count("*").alias("n"), *(f(c).alias(f.__name__ + c) for f in (F.min, F.max) for c in ("h2", "size")))
        repeated = stored(repeated.where("n > 1").selectExpr("node", "minh2 <> maxh2 or minsize <> maxsize AS clash"), "repeated",
                          "node bigint, clash boolean")
        if repeated.where("clash").isEmpty():
            break

    def valid(a: str, b: str) -> str:
        return f"(({a} & {INDEX}) <> 0 and ({b} & {PROBE}) <> 0 or ({b} & {INDEX}) <> 0 and ({a} & {PROBE}) <> 0)"

    def close(u: str, v: str) -> str:
        return " + ".join(f"bit_count({u}.s{k} ^ {v}.s{k})" for k in range(SKETCH_WORDS)) + f" <= {4 * limit}"

    roots = linked_classes(spark.createDataFrame([], "node bigint, rep bigint"), base.mapInArrow(_signatures(limit, least, values), SIGNATURE),
                           base.mapInArrow(_texts(least, values), "node bigint, text string"), _verify(limit), valid, _sketches, SKETCH_WORDS,
                           close, once=False)
    classes = repeated.select("node").join(roots, "node", "full").select("node", F.coalesce("root", "node").alias("root"))
    members = stored(lines.join(classes, "node").select("rid", "doc_id", "line", "root"), "line-members",
                     "rid bigint, doc_id bigint, line int, root bigint")
    discard(spark, line_path)
    first = members.groupBy("root").agg(F.min(F.struct("doc_id", "rid", "line")).alias("first"))
    gone = members.join(first, "root").where("rid <> first.rid or line <> first.line").groupBy("rid").agg(F.collect_set("line").alias("gone"))
    gone.write.parquet(gone_path)  # a row's list is no longer than its text
    gone = spark.read.schema("rid bigint, gone array<int>").parquet(gone_path)
    rows = base.select("rid", "doc_id", "text", F.split("text", "\n", -1).alias("lines"))
    rows = rows.join(gone.hint("merge"), "rid", "left")
    stay = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
                    lambda p: ~F.array_contains("gone", p["i"]))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda p: p["x"]), "\n"))
    return rows.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("bigint").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"), kept.alias("kept"))
