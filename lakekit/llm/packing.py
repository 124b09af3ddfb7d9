"""Best-two-fit packing of tokenized documents into sequences of at most CAP tokens.

`write_pieces` encodes every whole text with a public tokenizer and appends the end id. A document of more
than CAP ids is cut into pieces of CAP ids, of which only the first may be shorter; any other document
is one piece. `place` packs the pieces.

How well pieces fit depends on their lengths alone, so bins are planned on the number of pieces of each length:
CAP + 1 counts at any corpus size. A bin is filled greedily, always with the longest piece that fits; then its shortest
piece makes way for two unpacked pieces, if two fit the gap with that piece taken out more tightly. The bin so found is
made as many times as the counts allow, which at least uses up one length, so the plan is short
(`plan_bins`). It says, for each run of equal pieces by number, the sequences and offsets they get.

Pieces of a length are numbered by written task and place in it: tasks count their own pieces by length, and a
running sum over tasks gives each its first number. No group of equal lengths is ever gathered or sorted, so a third
of all pieces may be copies of one. Ids stay in the written pieces; only `sequences` moves them.

A null text is empty: the end id alone. Repeated rows and rows without an id are packed like any others; piece
numbers and starts count within a row. An empty table gives no pieces. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakekit.llm.arrays import byte_view, chunks, ragged
from lakekit.llm.workers import settled, table
from lakekit.session import cut_lineage, scratch_path

CAP = 1024
END_ID = 2
SLICE_CHARS = 1 << 22  # bytes encoded at once
FEW = 1_000_000  # rows of task counts that may be broadcast
PIECES = "doc_id bigint, piece int, start bigint, length int, task int, place bigint, ids binary"
PLAN = "length int, first bigint, n bigint, each int, sequence bigint, at int"

# Of texts in these signs alone, `cut_words` finds the words that the byte-level tokenizer's own pattern finds (a fixed rule of its
# vocabulary file); no token runs over the end of a word. 0: any other sign; letters: A-Z, a-z, À-ɏ without × and ÷, which are signs.
OTHER, LETTER, DIGIT, SIGN, BLANK, LINE = range(6)
KINDS = np.zeros(256, np.uint8)
KINDS[0x21:0x7F] = SIGN
for low, high, kind in ((0x41, 0x5A, LETTER), (0x61, 0x7A, LETTER), (0x30, 0x39, DIGIT), (0x20, 0x20, BLANK), (0x0A, 0x0A, LINE),
                        (0xC3, 0xC9, LETTER), (0x80, 0xBF, LETTER)):
    KINDS[low:high + 1] = kind
ROOM = 500_000


def _own_signs() -> np.ndarray:
    """The code point that stands for each byte in a byte-level vocabulary; line breaks stay, which part words."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    signs = np.arange(256, dtype="<u4")
    rest = [b for b in range(256) if b not in plain]
    signs[rest] = 256 + np.arange(len(rest))
    signs[0x0A] = 0x0A
    return signs


BYTE_SIGNS = _own_signs()


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in the bytes of texts (each word ends where the next starts), and the rows that hold other signs.

    Words: ` ?letters`, `'s 't 're 've 'm 'll 'd`, ` ?digits`, ` ?signs`, white space up to the last sign before ink, white space.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = KINDS[data]
    odd = kind == OTHER
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)  # a special token's string is cut out before words are
    if data.max() >= 0x80:
        lead, rest = (data >= 0xC3) & (data <= 0xC9), (data & 0xC0) == 0x80
        odd[1:] |= (rest[1:] != lead[:-1]) | ((data[:-1] == 0xC9) & (data[1:] > 0x8F))
        odd[0] |= rest[0]
        odd[-1] |= lead[-1]
        sign = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
        kind[sign] = kind[sign + 1] = SIGN
    first = np.zeros(len(data) + 3, bool)  # where texts begin, and the end
    first[offsets] = True
    first[len(data):] = True
    white = kind >= BLANK
    start = first[:len(data)].copy()
    before, own = kind[:-1], kind[1:]
    start[1:] |= np.where(white[1:], ~white[:-1], (before == LINE) | (~white[:-1] & (own != before)))
    start[:-1] |= white[:-1] & ~white[1:] & ~first[1:len(data)]  # the last white sign before ink
    at = np.flatnonzero(start & (data == 0x27))
    if len(at):
        after = np.append(data, np.zeros(3, np.uint8))
        one, two = after[at + 1], after[at + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & ~first[at + 1]
        pair = (((one == 0x72) | (one == 0x76)) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C))
        long = pair & ~first[at + 1] & ~first[at + 2]
        start[at[short | long] + 1] = False
        end = np.concatenate([at[short] + 2, at[long] + 3])
        start[end[end < len(data)]] = True
    rows = np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1
    return np.flatnonzero(start), np.unique(rows)


class WordEncoder:
    """Ids of texts through a bounded table of the words seen so far, each encoded by the tokenizer once.

    Arrow tells the distinct words of a stretch of texts. New ones go to the tokenizer's model as lines of byte signs, so without
    its pattern; the widths of the ids in bytes say which word each belongs to.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = Split("\n", "removed")
        vocabulary = self.words.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.width[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.reset()

    def reset(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.flat, self.starts, self.sizes, self.hits = np.zeros(0, np.uint32), *(np.zeros(0, np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keep the words that came up again; most of a long table came up once."""
        keep = self.hits > 1
        if keep.sum() > ROOM // 2:
            self.reset()
            return
        number = np.cumsum(keep) - 1
        self.codes = {w: int(number[c]) for w, c in self.codes.items() if keep[c]}
        at = ragged(self.starts[keep], self.sizes[keep])
        self.flat, self.sizes, self.hits = self.flat[at], self.sizes[keep], self.hits[keep]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.codes)
        self.codes.update(zip(words, range(known, known + len(words))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, ids])
        self.hits = np.concatenate([self.hits, np.zeros(len(words), np.int64)])

    def _learn(self, words: list[bytes]) -> None:
        """Encode words as lines of one text; white space and words with a sign that the vocabulary lacks go one by one."""
        inked, rest = [w for w in words if not w.isspace()], [w for w in words if w.isspace()]
        if inked:
            text = BYTE_SIGNS[np.frombuffer(b"\n".join(inked), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(np.fromiter(map(len, inked), np.int64, len(inked)))
            reached = np.cumsum(self.width[ids])
            upto = np.searchsorted(reached, ends, "right")
            if upto[-1] == len(ids) and (reached[upto - 1] == ends).all():
                self._add(inked, ids, np.diff(upto, prepend=0))
            else:
                rest = words
        for word in rest:
            own = self._ids(word.decode())
            self._add([word], own, np.array([len(own)]))

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and how many each has."""
        if len(self.codes) > ROOM:
            self._forget()
        texts = _texts(texts)
        data, offsets = byte_view(texts)
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        starts, odd = cut_words(data, offsets)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)])
        cuts = np.searchsorted(starts, offsets)
        if len(odd):
            keep = np.ones(len(starts), bool)
            keep[ragged(cuts[odd], cuts[odd + 1] - cuts[odd])] = False
            words, cuts = words.filter(pa.array(keep)), np.append(0, np.cumsum(keep))[cuts]
        found = words.dictionary_encode()
        distinct, place = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
        codes = np.array([self.codes.get(w, -1) for w in distinct], np.int64)
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            self._learn([distinct[i] for i in missing])
            codes[missing] = [self.codes[distinct[i]] for i in missing]
        self.hits[codes] += np.bincount(place, minlength=len(distinct))
        codes = codes[place]
        each = self.sizes[codes]
        ends = np.append(0, np.cumsum(each))[cuts]
        ids, sizes = self.flat[ragged(self.starts[codes], each)], np.diff(ends)
        if len(odd):
            whole = {k: self._ids(texts[k].as_py()) for k in odd.tolist()}
            ids = np.concatenate([x for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])) for x in (ids[a:b], whole.get(k, ids[:0]))])
            for k, own in whole.items():
                sizes[k] = len(own)
        return ids, sizes


@table
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _texts(texts: pa.Array | list[str]) -> pa.Array:
    return (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")


def _slices(texts: pa.Array | list[str]) -> Iterator[tuple[int, int]]:
    for chunk in chunks(_texts(texts), SLICE_CHARS):
        yield chunk.lo, chunk.hi


def cut_pieces(totals: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, piece, start, length) of the pieces of rows of `totals` ids."""
    head = totals % cap
    parts = totals // cap + (head > 0)
    row = np.repeat(np.arange(len(totals)), parts)
    piece = ragged(np.zeros(len(totals), np.int64), parts)
    first = np.where(head > 0, head, cap)[row]
    start = np.where(piece == 0, 0, first + (piece - 1) * cap)
    return row, piece, start, np.where(piece == 0, first, cap)


def _pieces(path: str, cap: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = _encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(cap + 1, np.int64)
        for batch in batches:
            every = batch.column(1)
            for lo, hi in _slices(every):
                ids, sizes = encoder.encode(every.slice(lo, hi - lo))
                totals = sizes + 1
                ends = np.cumsum(totals)
                whole = np.full(int(ends[-1]), end_id, np.uint32)
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = ids
                row, piece, start, length = cut_pieces(totals, cap)
                order = np.argsort(length, kind="stable")
                counts = np.bincount(length, minlength=cap + 1)
                place = np.empty(len(length), np.int64)
                place[order] = ragged(seen, counts)
                seen += counts
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [
                    None, pa.py_buffer(4 * np.append(0, np.cumsum(length))), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()), pa.array(np.full(len(length), task), pa.int32()), pa.array(place),
                    blobs.cast(pa.binary())], names=["doc_id", "piece", "start", "length", "task", "place", "ids"])

    return run


def write_pieces(docs: DataFrame, tokenizer: str, cap: int = CAP, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The pieces of all documents, written with their ids (little-endian unsigned 32-bit) and read back."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "pieces")
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    plain.mapInArrow(settled(_pieces(tokenizer, cap, end_id), _encoder), PIECES).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(PIECES).parquet(path)


def best_two(left: np.ndarray, room: int) -> tuple[int, int]:
    """The two lengths a >= b still in `left` of the largest sum within `room`, of equal sums the one of largest a; (0, 0) if none."""
    there = left[:room + 1] > 0
    upto = np.maximum.accumulate(np.where(there, np.arange(len(there)), 0))  # the longest length of at most i
    a = np.flatnonzero(there)
    a = a[a < room]
    if not len(a):
        return 0, 0
    b = upto[np.minimum(room - a, a)]
    alone = (b == a) & (left[a] < 2)
    b[alone] = upto[a[alone] - 1]
    total = np.where(b > 0, a + b, 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(a[best]), int(b[best])) if total[best] else (0, 0)


def fill_bin(counts: np.ndarray, cap: int) -> np.ndarray:
    """How many pieces of each length the next bin takes."""
    left, used, gap = counts.copy(), np.zeros_like(counts), cap
    while gap:
        fits = np.flatnonzero(left[:gap + 1])
        if not len(fits):
            break
        length = int(fits[-1])
        n = min(int(left[length]), gap // length)
        used[length] += n
        left[length] -= n
        gap -= n * length
    if gap:
        least = int(np.flatnonzero(used)[0])
        a, b = best_two(left, gap + least)
        if a + b > least:
            used[least] -= 1
            used[a] += 1
            used[b] += 1
    return used


def plan_bins(counts: np.ndarray, cap: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, n, each, sequence, at): the pieces number first .. first + n - 1 of a length go, `each` to a
    sequence, to sequences from `sequence` on, from offset `at` on."""
    left, done = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    left[0] = 0
    rows, sequence = [], 0
    while left.any():
        used = fill_bin(left, cap)
        lengths = np.flatnonzero(used)[::-1]
        times, at = int((left[lengths] // used[lengths]).min()), 0
        for length in lengths.tolist():
            each = int(used[length])
            rows.append((length, int(done[length]), each * times, each, sequence, at))
            done[length] += each * times
            at += each * length
        left -= used * times
        sequence += times
    return rows


def place(pieces: DataFrame, cap: int = CAP) -> DataFrame:
    """The rows of `pieces`, any columns besides task, place and length, with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = cut_lineage(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    by_length = np.zeros(cap + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # cap rows at most
        by_length[row["length"]] = row["n"]
    plan = spark.createDataFrame(plan_bins(by_length, cap), PLAN)  # grows with cap, not with the pieces
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    base = F.broadcast(base) if counts.count() <= FEW else base
    numbered = pieces.join(base, ["task", "length"]).withColumn("_number", F.col("_base") + F.col("place")).alias("p")
    inside = F.expr("p.length = q.length and p._number >= q.first and p._number < q.first + q.n")
    placed = numbered.join(F.broadcast(plan.alias("q")), inside)
    return placed.select(
        *(F.col(f"p.{c}") for c in pieces.columns if c not in ("task", "place")),
        F.expr("q.sequence + (p._number - q.first) div q.each").alias("sequence_id"),
        F.expr("q.at + pmod(p._number - q.first, q.each) * q.length").cast("bigint").alias("offset"))


def pack(docs: DataFrame, tokenizer: str, cap: int = CAP, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids, sequence_id, offset."""
    return place(write_pieces(docs, tokenizer, cap, end_id, id_col, text_col), cap)


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence: sequence_id, ids (all of it), and the spans (offset, length, doc_id, start) in order; CAP pieces at most meet."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids"))).alias("_rows"))
    joined = F.aggregate("_rows", F.lit(b""), lambda whole, r: F.concat(whole, r["ids"]))
    spans = F.transform("_rows", lambda r: F.struct(r["offset"].alias("offset"), r["length"].alias("length"),
                                                    r["doc_id"].alias("doc_id"), r["start"].alias("start")))
    return rows.select("sequence_id", joined.alias("ids"), spans.alias("spans"))


def digest(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """`pack` with a checksum instead of the ids, which are checked where they were written and never moved."""
    pieces = write_pieces(docs, tokenizer)
    placed = place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "sequence_id", "offset")
