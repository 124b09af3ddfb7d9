"""Token ids in Huffman-coded files: canonical length-limited codes, blocks that decode alone.

`write_tokens` encodes every whole text with a public tokenizer, appends the end id to
each document, counts all ids over all documents, builds canonical Huffman codes of at
most LIMIT bits by package-merge, and writes the documents in ascending id order. `read_tokens`
reads the files back and decodes them through a lookup table.

File format, in a folder: `codebook` holds (id, bits), one row per id in use; the codes follow
from the lengths alone, shorter first, then by id. `blocks` holds rows of whole documents of about BLOCK
ids: `part` and `block` give the order, `before` the ids that precede the block in its part, `docs` and
`sizes` the documents with their id counts, `code` the bit stream (most significant bit
first) and `marks` the bit offset of every MARK-th id, as little-endian unsigned 32-bit integers. A block, and any
stretch between marks, decodes without what precedes it. The rows are kept in Parquet, so Spark's commit
protocol guards them against lost executors.

A null text is an empty one: the end id alone. Null ids come first. Repeated documents are all
written; equal ids are ordered by their contents. An empty table gives empty files. Only the named columns
are read. A text is cut at spaces and line breaks, where the tokenizer never joins, and each piece is encoded
by the tokenizer once per task and looked up from then on. Arrow cuts a stretch of texts and tells its distinct pieces. Words of
letters are put in lower case here, so the tokenizer's model takes them without its normalizer and word pattern.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm.arrays import byte_view, chunks, ragged
from lakekit.llm.workers import settled, table
from lakekit.session import scratch_path

LIMIT = 16
BLOCK = 1 << 19
MARK = 256
END_ID = 1
CACHE_WORDS = 400_000
SLICE = 1 << 22  # bytes encoded at once
WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[,.]?$"  # letters whose lower case is one letter of the same range


class PieceEncoder:
    """Ids of texts, through a bounded table of the pieces seen so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary, suffix = self.words.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.closing[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.tails = {"": -1} | {t: self.tokenizer.encode(t, add_special_tokens=False).ids[0] for t in ",."}
        self.reset()

    def reset(self) -> None:
        self.codes: dict[str, int] = {"": 0}
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.hits = np.zeros(1, np.int64)

    def _forget(self) -> None:
        """Keep the pieces that came up more than once; most of a long table came up once."""
        keep = self.hits > 1
        keep[0] = True
        number = np.cumsum(keep) - 1
        self.codes = {p: int(number[c]) for p, c in self.codes.items() if keep[c]}
        at = ragged(self.starts[keep], self.sizes[keep])
        self.flat, self.sizes, self.hits = self.flat[at], self.sizes[keep], self.hits[keep]
        self.starts = np.cumsum(self.sizes) - self.sizes
        if len(self.codes) > CACHE_WORDS // 2:
            self.reset()

    def _learn(self, pieces: list[str]) -> None:
        """Add new pieces: each by its plain form, which most of them share with others."""
        every = pa.array(pieces, pa.string())
        words = pc.match_substring_regex(every, WORD)
        is_word = words.to_numpy(zero_copy_only=False)
        some = every.filter(words)
        plain = list(zip(pc.utf8_lower(pc.utf8_rtrim(some, ",.")).to_numpy(zero_copy_only=False).tolist(), some.to_numpy(zero_copy_only=False).tolist()))
        self._learn_plain([(p, f, p[-1] if p[-1] in ",." else "") for f, p in plain], True)
        self._learn_plain([(pieces[i], *_plain(pieces[i])) for i in np.flatnonzero(~is_word).tolist()], False)

    def _learn_plain(self, plain: list[tuple[str, str, str]], words: bool) -> None:
        """Add pieces given with their plain forms and closing signs."""
        fresh = [f for f in dict.fromkeys(f for _, f, _ in plain) if f not in self.codes]
        if fresh:
            self._encode(fresh, words)
        rest = [(p, self.codes[f], self.tails[t]) for p, f, t in plain if p not in self.codes]
        if not rest:
            return
        form, tail = np.array([f for _, f, _ in rest], np.int64), np.array([t for _, _, t in rest], np.int64)
        sizes = self.sizes[form]
        ends = np.cumsum(sizes + 1)
        flat = np.zeros(int(ends[-1]), np.uint32)
        flat[ragged(ends - sizes - 1, sizes)] = self.flat[ragged(self.starts[form], sizes)]
        flat[ends - 1] = np.maximum(tail, 0)  # unused without a tail
        self._add([p for p, _, _ in rest], flat, ends - sizes - 1, sizes + (tail >= 0))

    def _encode(self, pieces: list[str], words: bool) -> None:
        """Encode pieces as one text; each id belongs to the piece at its place, or to the word that the next closing id ends."""
        text = " ".join(pieces)
        if words:
            ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            sizes = np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)
        if not words or len(sizes) != len(pieces):
            encoded = self.tokenizer.encode(text, add_special_tokens=False)
            ids = np.array(encoded.ids, np.uint32)
            lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
            begins = np.cumsum(lengths + 1) - lengths - 1
            places = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(encoded))
            sizes = np.bincount(np.searchsorted(begins, places, "right") - 1, minlength=len(pieces))
        self._add(pieces, ids, np.cumsum(sizes) - sizes, sizes)

    def _add(self, pieces: list[str], flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.codes)
        self.codes.update(zip(pieces, range(known, known + len(pieces))))
        self.starts, self.sizes = np.concatenate([self.starts, len(self.flat) + starts]), np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])
        self.hits = np.concatenate([self.hits, np.zeros(len(pieces), np.int64)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and how many each has."""
        if len(self.codes) > CACHE_WORDS:
            self._forget()
        cut = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        found = cut.flatten().dictionary_encode()
        pieces, place = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
        codes = np.array([self.codes.get(p, -1) for p in pieces], np.int64)
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            self._learn([pieces[i] for i in missing.tolist()])
            codes[missing] = [self.codes[pieces[i]] for i in missing.tolist()]
        self.hits[codes] += np.bincount(place, minlength=len(pieces))
        codes = codes[place]
        sizes = self.sizes[codes]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[ragged(self.starts[codes], sizes)], np.diff(total[np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])])


def _plain(piece: str) -> tuple[str, str]:
    """A piece's form in lower case without a closing comma or full stop, and that sign.

    The tokenizer lower-cases, and a sign after a letter or digit is a token run of its own, so both give the same
    ids. Other scripts, whose case rules differ, and texts that may hold a special token stay as they are.
    """
    if not piece.isascii() or "<|" in piece:
        return piece, ""
    if len(piece) > 1 and piece[-1] in ",." and piece[-2].isalnum():
        return piece[:-1].lower(), piece[-1]
    return piece.lower(), ""


@table
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _tokenize(path: str, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for chunk in chunks(batch.column(1), SLICE):
                ids, sizes = encoder.encode(batch.column(1).slice(chunk.lo, chunk.rows))
                ends = np.cumsum(sizes + 1)
                whole = np.full(int(ends[-1]), end_id, kind)
                whole[ragged(ends - sizes - 1, sizes)] = ids
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), chunk.rows, [
                    None, pa.py_buffer(np.append(0, ends * whole.itemsize)), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.lo, chunk.rows), blobs.cast(pa.binary())], names=["doc_id", "ids"])

    return run


def _count(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            data, offsets = byte_view(batch.column(0))
            own = np.bincount(data[offsets[0]:offsets[-1]].view(kind), minlength=len(total))
            own[:len(total)] += total
            total = own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    return run


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each symbol in the best prefix code with no code longer than `limit` (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    limit = max(limit, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    merged, rounds = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        merged = both[place]
        rounds.append(place < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(rounds):
        used = int(is_leaf[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


def canonical_codes(ids: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, codes): the symbols by (bits, id) and their consecutive codes."""
    order = np.lexsort((ids, bits))
    sorted_bits = bits[order]
    top = int(sorted_bits[-1]) if len(order) else 0
    step = np.left_shift(np.int64(1), top - sorted_bits)  # share of the code space, in units of the longest code
    return order, (np.cumsum(step) - step) >> (top - sorted_bits)


def _pack(ids: np.ndarray, code_of: np.ndarray, bits_of: np.ndarray) -> tuple[bytes, np.ndarray]:
    bits = bits_of[ids]
    ends = np.cumsum(bits)
    at = ends - bits
    word, shift = at >> 5, (64 - (at & 31) - bits).astype(np.uint64)
    wide = code_of[ids] << shift
    size = int(ends[-1] >> 5) + 2
    # codes never overlap, so adding their shifted bits is joining them; sums stay below 2**32
    words = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), size) + np.bincount(
        word + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
    return words.astype(np.uint64).astype(">u4").tobytes()[:int(ends[-1] + 7) >> 3], at[::MARK].astype("<u4")


BLOCKS = ("part int, block int, before bigint, n_ids bigint, docs array<bigint>, sizes array<bigint>, code binary, marks binary")


def _blocks(book, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bits = book.value
        order, codes = canonical_codes(ids, bits)
        code_of, bits_of = np.zeros(int(ids.max(initial=0)) + 1, np.uint64), np.zeros(int(ids.max(initial=0)) + 1, np.int64)
        code_of[ids[order]], bits_of[ids] = codes.astype(np.uint64), bits
        part, block, before, width = TaskContext.get().partitionId(), 0, 0, np.dtype(kind).itemsize

        def flush(docs, blobs):
            nonlocal block, before
            own = np.concatenate([np.frombuffer(b, kind) for b in blobs])
            code, marks = _pack(own, code_of, bits_of)
            row = [part, block, before, len(own), docs, [len(b) // width for b in blobs], code, marks.tobytes()]
            block, before = block + 1, before + len(own)
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              names=["part", "block", "before", "n_ids", "docs", "sizes", "code", "marks"])

        docs, blobs, size = [], [], 0
        for batch in batches:
            for doc, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                docs.append(doc)
                blobs.append(blob)
                size += len(blob) // width
                if size >= BLOCK:
                    yield flush(docs, blobs)
                    docs, blobs, size = [], [], 0
        if docs:
            yield flush(docs, blobs)

    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, limit: int = LIMIT) -> str:
    """Write `codebook` and `blocks` under `path` (a fresh shared folder by default) and return it."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    raw = scratch_path(spark, "token-ids")
    kind = "<u2" if max(_encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    plain.mapInArrow(settled(_tokenize(tokenizer, end_id, kind), _encoder), "doc_id bigint, ids binary").write.option("compression", "zstd").parquet(raw)
    tokens = spark.read.schema("doc_id bigint, ids binary").parquet(raw)
    counted = tokens.select("ids").mapInArrow(settled(_count(kind)), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    rows = sorted(counted.collect())  # one row per id in use, at most the vocabulary
    ids, bits = np.array([r["id"] for r in rows], np.int64), code_lengths(np.array([r["n"] for r in rows], np.int64), limit)
    spark.createDataFrame([(int(a), int(b)) for a, b in zip(ids, bits)], "id bigint, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    # the content hash splits ranges of one repeated id
    ordered = tokens.withColumn("h", F.xxhash64("ids")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "ids")
    ordered.select("doc_id", "ids").mapInArrow(settled(_blocks(spark.sparkContext.broadcast((ids, bits)), kind)), BLOCKS).write.option(
        "compression", "none").parquet(f"{path}/blocks")
    return path


def decoder(ids: np.ndarray, bits: np.ndarray):
    """A function (code bytes, marks, count) -> ids, by lookups of the longest code's width."""
    order, codes = canonical_codes(ids, bits)
    top = int(bits.max(initial=1))
    span = np.left_shift(1, top - bits[order])
    symbol, width = np.repeat(ids[order], span).astype(np.uint32), np.repeat(bits[order], span).astype(np.int64)
    room = (1 << top) - len(symbol)  # a lone symbol leaves half the table unused
    symbol, width = np.pad(symbol, (0, room)), np.pad(width, (0, room), constant_values=1)

    def decode(code: bytes, marks: np.ndarray, count: int) -> np.ndarray:
        raw = np.frombuffer(code + bytes(8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, last = marks.astype(np.int64), len(window) - 1
        out = np.zeros((MARK, len(at)), np.uint32)
        for step in range(MARK):  # all stretches advance together
            look = (window[np.minimum(at >> 3, last)] >> (32 - top - (at & 7)).astype(np.uint32)) & np.uint32((1 << top) - 1)
            out[step] = symbol[look]
            at = at + width[look]
        return out.T.reshape(-1)[:count]

    return decode


def _decode(book, base, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = decoder(*book.value)
        starts, names = base.value, ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
        for batch in batches:
            for row in batch.to_pylist():
                own = decode(row["code"], np.frombuffer(row["marks"], "<u4"), row["n_ids"]).astype("<u4")
                sizes = np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                whole = own.tobytes()
                blobs = [whole[4 * (b - n):4 * b] for b, n in zip(ends.tolist(), sizes.tolist())]
                columns = [pa.array(row["docs"], pa.int64()), pa.array(starts[row["part"]] + row["before"] + ends - sizes, pa.int64()),
                           pa.array(sizes, pa.int64()), pa.array(map(zlib.crc32, blobs), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(blobs, pa.binary())] if ids else [])], names=names)

    return run


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32, and with `ids` its ids (little-endian unsigned 32-bit)."""
    rows = sorted(spark.read.schema("id bigint, bits int").parquet(f"{path}/codebook").collect())
    book = np.array([r["id"] for r in rows], np.int64), np.array([r["bits"] for r in rows], np.int64)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    base, total = {}, 0
    for part, n in sorted(blocks.groupBy("part").agg(F.sum("n_ids")).collect()):  # one row per written part
        base[part], total = total, total + n
    share = spark.sparkContext.broadcast
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids
    return blocks.mapInArrow(settled(_decode(share(book), share(base), ids)), schema)
