"""Suffix-array dedup: remove every byte covered by a WIN-byte string that also starts elsewhere.

Suffixes are dealt to tasks so that equal WIN-byte strings meet. Each WIN-byte window has an
anchor: the GRAM-byte string of least hash inside it, the rightmost one on ties. Equal windows have equal anchors at
equal places, so only occurrences of the same anchor can hold equal windows, and neighbouring
windows mostly share their anchor: a run is the windows of one anchor occurrence.

Runs that are equal as wholes are settled by their hashes. Where an anchor has different
runs, one of each kind goes to a suffix array. It is built by two-stage sorting of the window
starts: the suffixes smaller than their successors are sorted directly (on WIN bytes, all that
counts here), the rest are induced by scanning the buckets of first bytes in order, each
suffix passing its place on to the one before it. Neighbours in the array whose common prefix
reaches WIN bytes mark both windows.

An anchor with more than GROUP kinds of runs would crowd one task; its windows
are compared by 128-bit hashes, added up before the shuffle. Both ways are exact up to hash
collisions of 64 bits within an anchor, and there is no cap.

Null texts are empty. Texts are UTF-8 bytes; matches never cross documents. Repeated rows are documents
of their own and cover each other. Texts shorter than WIN keep all bytes. Only the named
columns are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrays import BYTE_VALUES, chunks, mix, prefix_hash, span_hash
from lakekit.session import scratch_path

WIN, GRAM = 200, 64
GROUP = 4000
SORT_STARTS = 1 << 17

RUNS = "anchor bigint, kind bigint, rid bigint, lo int, hi int"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    cover = 1
    while cover * 2 <= width:
        values = np.minimum(values[:-cover], values[cover:])
        cover *= 2
    return np.minimum(values[:-(width - cover)], values[width - cover:]) if cover < width else values


def chunk_runs(chunk, win: int, gram: int):
    """(anchor hash, run hash, row, first start, last start) of the window runs of a chunk."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    n = len(chunk.data)
    if n < win:
        return none
    prefix = prefix_hash(BYTE_VALUES[chunk.data])
    at = np.arange(n - gram + 1, dtype=np.int64)
    hashes = span_hash(prefix, at, at + gram)
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - at.astype(np.uint64))
    least = _sliding_min(ranked, win - gram + 1)
    place = np.int64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(chunk.rows), chunk.lengths)[:len(place)]
    start = np.flatnonzero(np.arange(len(place)) + win <= chunk.offsets[row + 1])
    if not len(start):
        return none
    cut = np.flatnonzero((place[start[1:]] != place[start[:-1]]) | (start[1:] != start[:-1] + 1))
    lo, hi = start[np.append(0, cut + 1)], start[np.append(cut, len(start) - 1)]
    spot = place[lo]
    kind = span_hash(prefix, lo, hi + win) ^ mix((spot - lo).astype(np.uint64) * np.uint64(1 << 32) + (hi - lo).astype(np.uint64))
    row = row[lo]
    return hashes[spot], kind, row, lo - chunk.offsets[row], hi - chunk.offsets[row]


def _runs(win: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(1)):
                anchor, kind, row, lo, hi = chunk_runs(chunk, win, gram)
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor.view(np.int64)), pa.array(kind.view(np.int64)), pa.array(rids[chunk.lo + row]),
                    pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["anchor", "kind", "rid", "lo", "hi"])

    return run


FOUND = "anchor bigint, kind bigint, rid bigint, lo int, hi int, copied boolean, open boolean"


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, kind): `copied` marks runs with an equal run, `open` one run of each kind of
    an anchor with several kinds. Only the last kind's first and last rows are held between batches; their
    marks may come twice, never not at all."""
    held = [np.zeros(0, np.int64) for _ in range(5)]
    joined = False  # whether the held kind follows another kind of its anchor

    def judge(columns, final: bool):
        nonlocal held, joined
        anchor, kind = columns[0], columns[1]
        n = len(anchor)
        if not n:
            return None
        same_anchor = anchor[1:] == anchor[:-1]
        same = same_anchor & (kind[1:] == kind[:-1])
        copied = np.zeros(n, bool)
        copied[1:] |= same
        copied[:-1] |= same
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        open_ = np.zeros(n, bool)
        links = anchor[starts[1:]] == anchor[starts[:-1]]
        open_[starts[1:]] |= links
        open_[starts[:-1]] |= links
        open_[0] |= joined
        last = int(starts[-1])
        if not final:
            joined = bool(links[-1]) if len(links) else joined
            keep = [last] if last == n - 1 else [last, n - 1]
            held = [c[keep] for c in columns]
        # the held kind's first row is judged again with what follows, so it is not sent as open yet
        send = copied | open_
        if not final:
            open_[last] = False
            send = copied | open_
        return pa.RecordBatch.from_arrays([*(pa.array(c[send]) for c in columns[:3]), *(pa.array(c[send].astype(np.int32)) for c in columns[3:]),
                                           pa.array(copied[send]), pa.array(open_[send])],
                                          names=["anchor", "kind", "rid", "lo", "hi", "copied", "open"])

    for batch in batches:
        if batch.num_rows:
            yield judge([np.concatenate([h, c.to_numpy().astype(np.int64)]) for h, c in zip(held, batch.columns)], False)
    done = judge(held, True)
    if done is not None:
        yield done


def _regions(win: int):
    """Texts with their open runs -> the bytes each run's windows need, for the suffix array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            for rid, text, opens in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                for o in opens:
                    # the chain of induced suffixes ends at the first byte that is smaller than the next one
                    end = o["hi"] + 1
                    while end + 1 < len(raw) and raw[end] >= raw[end + 1]:
                        end += 1
                    for x, v in zip(out, (o["anchor"], rid, o["lo"], o["hi"], raw[o["lo"]:end + win], o["copied"])):
                        x.append(v)
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["anchor", "rid", "lo", "hi", "bytes", "copied"])

    return run


def sort_starts(parts: list[bytes], counts: list[int], win: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of the first counts[i] starts of each part, compared on `win` bytes, by two-stage sorting.

    Returns the joined bytes, the ordered starts in them, and each start's part.
    """
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes)
    begins, n = ends - sizes, len(data)
    part_of = np.repeat(np.arange(len(parts)), sizes)
    nxt = np.full(n, -1, np.int16)  # the end of a part is smaller than any byte
    nxt[:-1] = data[1:]
    nxt[ends - 1] = -1
    # in a stretch of equal bytes the byte after it decides whether a suffix is smaller than its successor
    differs = np.flatnonzero(nxt != data)
    decide = differs[np.searchsorted(differs, np.arange(n))]
    smaller = nxt[decide] > data[decide]
    entry, start = np.zeros(n + 1, bool), np.zeros(n, bool)
    for b, c, e in zip(begins.tolist(), counts, ends.tolist()):
        start[b:b + c] = True
        stop = b + c
        while stop < e and not smaller[stop]:
            stop += 1
        entry[b:min(stop + 1, e)] = True
    whole = data.tobytes()
    direct = np.flatnonzero(entry[:n] & smaller).tolist()
    direct.sort(key=lambda i: whole[i:min(i + win, int(ends[part_of[i]]))])
    direct = np.array(direct, np.int64)
    by_byte = np.split(direct, np.searchsorted(data[direct], np.arange(1, 256)))
    induced = entry[:n] & ~smaller
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]

    def pass_on(placed: np.ndarray, byte: int) -> np.ndarray:
        """Hand places on to the preceding suffixes; those in the same bucket are returned."""
        before = placed - 1
        before = before[placed > 0]
        before = before[induced[before] & (part_of[before] == part_of[before + 1])]
        first = data[before]
        here = before[first == byte]
        others = before[first > byte]
        if len(others):
            first = data[others]
            order = np.argsort(first, kind="stable")
            others, first = others[order], first[order]
            cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
            for piece in np.split(others, cuts):
                pending[data[piece[0]]].append(piece)
        return here

    tails = ends - 1
    tails = tails[induced[tails]]  # one-byte suffixes, whose successor is the empty one
    for piece in np.split(tails[np.argsort(data[tails], kind="stable")], np.searchsorted(np.sort(data[tails]), np.arange(1, 256))):
        if len(piece):
            pending[data[piece[0]]].append(piece)
    out = []
    for byte in range(256):
        placed = np.concatenate(pending[byte]) if pending[byte] else np.zeros(0, np.int64)
        while len(placed):
            out.append(placed)
            placed = pass_on(placed, byte)
        if len(by_byte[byte]):
            out.append(by_byte[byte])
            pass_on(by_byte[byte], byte)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return data, order[start[order]], part_of


def repeated_starts(parts: list[bytes], counts: list[int], win: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, offset) of every start whose `win` bytes also begin at another start."""
    data, order, part_of = sort_starts(parts, counts, win)
    begins = np.cumsum([0, *map(len, parts)])
    same = np.zeros(max(len(order) - 1, 0), bool)
    windows = np.lib.stride_tricks.sliding_window_view(data, win) if len(data) >= win else None
    for a in range(0, len(same), 8192):  # the common prefix of neighbours reaches win bytes
        b = min(a + 8192, len(same))
        same[a:b] = (windows[order[a:b]] == windows[order[a + 1:b + 1]]).all(axis=1)
    marked = np.zeros(len(order), bool)
    marked[1:] |= same
    marked[:-1] |= same
    hit = np.sort(order[marked])
    return part_of[hit], hit - begins[part_of[hit]]


SPANS = "rid bigint, a int, b int"


def _sort_groups(win: int):
    def solve(rows):
        part, offset = repeated_starts([r[4] for r in rows], [r[3] - r[2] + 1 for r in rows], win)
        keep = np.array([not r[5] for r in rows])[part] if len(part) else np.zeros(0, bool)  # copied runs are settled
        part, offset = part[keep], offset[keep]
        if not len(part):
            return None
        cut = np.flatnonzero((part[1:] != part[:-1]) | (offset[1:] != offset[:-1] + 1))
        first, last = np.append(0, cut + 1), np.append(cut, len(part) - 1)
        rid, lo = np.array([r[1] for r in rows], np.int64)[part[first]], np.array([r[2] for r in rows], np.int64)[part[first]]
        return pa.RecordBatch.from_arrays([pa.array(rid), pa.array((lo + offset[first]).astype(np.int32)),
                                           pa.array((lo + offset[last] + win).astype(np.int32))], names=["rid", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, starts = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if starts > SORT_STARTS and row[0] != rows[-1][0]:
                    done = solve(rows)
                    if done is not None:
                        yield done
                    rows, starts = [], 0
                rows.append(row)
                starts += row[3] - row[2] + 1
        if rows:
            done = solve(rows)
            if done is not None:
                yield done

    return run


def _window_hashes(win: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(4)):
                own = [c.slice(chunk.lo, chunk.rows).to_numpy(zero_copy_only=False) for c in (batch.column(0), batch.column(1), batch.column(2), batch.column(3), batch.column(5))]
                counts = (own[3] - own[2] + 1).astype(np.int64)
                row = np.repeat(np.arange(chunk.rows), counts)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = chunk.offsets[row] + offset
                prefix = prefix_hash(BYTE_VALUES[chunk.data])
                other = prefix_hash(mix(BYTE_VALUES[chunk.data]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(span_hash(prefix, at, at + win).view(np.int64)), pa.array(span_hash(other, at, at + win).view(np.int64)),
                    pa.array(own[1][row]), pa.array((own[2][row] + offset).astype(np.int32)), pa.array(own[4][row])],
                    names=["h1", "h2", "rid", "a", "copied"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[] for _ in range(5)]
        for doc, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            raw = (text or "").encode()
            runs: list[list[int]] = []
            for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            at, kept = 0, []
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            for x, v in zip(out, (doc, len(raw), sum(b - a for a, b in runs), runs, b"".join(kept))):
                x.append(v)
        kinds = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["doc_id", "n_bytes", "n_removed", "runs", "kept"])


def remove_repeats(docs: DataFrame, win: int = WIN, gram: int = GRAM, group: int = GROUP, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, `runs` (removed [start, end) byte runs) and the `kept` bytes."""
    spark = docs.sparkSession
    base_path, found_path = scratch_path(spark, "texts"), scratch_path(spark, "runs")
    numbered = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # rows need names of their own: ids may repeat
    numbered.withColumn("rid", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(base_path)
    base = spark.read.schema("doc_id bigint, text string, rid bigint").parquet(base_path)
    runs = base.select("rid", "text").mapInArrow(_runs(win, gram), RUNS)
    runs.repartition("anchor").sortWithinPartitions("anchor", "kind").mapInArrow(_settle, FOUND).write.option("compression", "zstd").parquet(found_path)
    found = spark.read.schema(FOUND).parquet(found_path)
    spans = found.where("copied").select("rid", F.col("lo").alias("a"), (F.col("hi") + win).alias("b"))

    unsettled = found.where("open").groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copied").alias("settled")).where("not settled")
    opens = found.where("open").join(unsettled.select("anchor", "kinds"), "anchor")
    per_text = opens.groupBy("rid").agg(F.collect_list(F.struct("anchor", "lo", "hi", "copied", "kinds")).alias("opens"))
    # one list per text, no longer than the text
    for crowded in (False, True):
        wanted = F.filter("opens", lambda o: (o["kinds"] > group) if crowded else (o["kinds"] <= group))
        own = per_text.withColumn("opens", wanted).where(F.size("opens") > 0)
        regions = base.select("rid", "text").join(own, "rid").select("rid", "text", "opens").mapInArrow(
            _regions(win), "anchor bigint, rid bigint, lo int, hi int, bytes binary, copied boolean")
        if not crowded:
            spans = spans.union(regions.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_groups(win), SPANS))
        else:
            hashed_path = scratch_path(spark, "windows")
            regions.mapInArrow(_window_hashes(win), "h1 bigint, h2 bigint, rid bigint, a int, copied boolean").write.parquet(hashed_path)
            hashed = spark.read.schema("h1 bigint, h2 bigint, rid bigint, a int, copied boolean").parquet(hashed_path)
            twice = hashed.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
            spans = spans.union(hashed.where("not copied").join(twice, ["h1", "h2"]).select("rid", "a", (F.col("a") + win).alias("b")))
    gathered = spans.groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return base.join(gathered, "rid", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id bigint, n_bytes bigint, n_removed bigint, runs array<array<bigint>>, kept binary")
