"""Benchmark decontamination over a distributed positional inverted index.

`build_index` cuts the documents into shards of whole documents and stores, for every
shard, the postings of all its words: word hash -> positions. `phrase_matches`
looks up every benchmark phrase by intersecting the offset-adjusted position lists of
its words, the globally rarest word first, and gives exact phrase hits; with `near` it
also gives items whose rarest words stand close together. Only words that the corpus has are
taken for that, so an item of which some words were altered is still found near; an item with none
of its words in the corpus is near nothing.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of any non-ASCII
characters; they are known by 64-bit hashes. Null and empty texts have no words and no
hits. An item with fewer words than the window is one phrase of its own length, an item
without words never occurs. Repeated documents are each matched; repeated items are each
counted. Only the named id and text columns are read, so other columns don't matter.

The index is document-sharded: no posting is ever shuffled, a common word only makes its
shard's list longer, and a lost task rebuilds or rereads its own shards. Phrases travel
to the shards in blocks of at most BLOCK_WORDS benchmark words, one pass over the index
for each block, so what is broadcast is bounded however large the benchmark is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrays import BYTE_VALUES, CHUNK, byte_class, chunks, fold_case, prefix_hash, span_hash, word_spans
from lakekit.llm.shards import arrays, write_shards
from lakekit.llm.workers import settled
from lakekit.session import scratch_path

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 1 << 20
NEAR_TERMS, NEAR_SPAN = 4, 24
WORD = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)

INDEX = "shard bigint, docs array<bigint>, first array<bigint>, words binary, ends binary, places binary"
_ARRAYS = {"words": np.uint64, "ends": np.uint32, "places": np.uint32}


def _words(chunk):
    data = fold_case(chunk.data)
    starts, ends, rows = word_spans(chunk, data, WORD)
    return span_hash(prefix_hash(BYTE_VALUES[data]), starts, ends), rows


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[list, np.ndarray, np.ndarray]] = []  # (ids, words, words per document), hashed chunk by chunk
    size = 0

    def flush() -> pa.RecordBatch:
        ids = [i for own, _, _ in held for i in own]
        words = np.concatenate([w for _, w, _ in held])
        rows = np.concatenate([[0], np.cumsum(np.concatenate([n for _, _, n in held]))])
        held.clear()
        order = np.argsort(words, kind="stable").astype(np.uint32)
        ordered = words[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(ordered)).astype(np.uint32) if len(ordered) else np.zeros(0, np.uint32)
        return pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
            pa.array([rows.tolist()], pa.list_(pa.int64())), pa.array([ordered[first].tobytes()], pa.binary()),
            pa.array([ends.tobytes()], pa.binary()), pa.array([order.tobytes()], pa.binary())],
            names=["shard", "docs", "first", "words", "ends", "places"])

    for batch in batches:
        for chunk in chunks(batch.column(1), min(CHUNK, SHARD_BYTES)):
            if held and size + len(chunk.data) > SHARD_BYTES:
                yield flush()
                size = 0
            words, rows = _words(chunk)
            held.append((batch.column(0).slice(chunk.lo, chunk.rows).to_pylist(), words, np.diff(rows)))
            size += len(chunk.data)
    if held:
        yield flush()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the shard index of all documents under the shared folder and return it as read back."""
    path = path or scratch_path(docs.sparkSession, "phrase-index")
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return write_shards(plain.mapInArrow(settled(_index), INDEX), path)


def _phrases(items: list[tuple], window: int) -> dict:
    """Packed phrases of one block of items: word hashes of every window, with item numbers."""
    texts = pa.array([t for _, t in items], pa.string())
    lists = []
    for chunk in chunks(texts):
        words, rows = _words(chunk)
        lists += [words[a:b] for a, b in zip(rows[:-1], rows[1:])]
    phrases, owner = [], []
    for k, words in enumerate(lists):
        if len(words):
            width = min(window, len(words))
            for at in range(len(words) - width + 1):
                phrases.append(words[at:at + width])
                owner.append(k)
    return {"items": [i for i, _ in items], "words": lists, "phrases": phrases, "owner": owner}


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[dict]:
    """Items streamed to the driver one block at a time; a block never holds more than BLOCK_WORDS words."""
    block, size = [], 0
    for item, text in benchmark.select(id_col, text_col).toLocalIterator():
        n = len((text or "").encode()) // 2 + 1  # no text has more words than that
        if block and size + n > BLOCK_WORDS:
            yield _phrases(block, window)
            block, size = [], 0
        block.append((item, text))
        size += n
    if block:
        yield _phrases(block, window)


def _runs(starts: np.ndarray, width: np.ndarray) -> list[list[int]]:
    """Merged [start, end) runs of the sorted spans."""
    out: list[list[int]] = []
    for a, w in zip(starts.tolist(), width.tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], a + w)
        else:
            out.append([a, a + w])
    return out


MATCH = "shard bigint, row int, doc_id bigint, n_words bigint, items array<string>, runs array<struct<a:bigint,b:bigint>>, near array<string>"


def _matcher(block, counts, near: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, rank = block.value, counts.value
        plans = []
        for phrase, owner in zip(packed["phrases"], packed["owner"]):
            totals = [rank.get(int(w), 0) for w in phrase]
            if min(totals):  # a word the corpus lacks rules the phrase out
                plans.append((sorted(range(len(phrase)), key=totals.__getitem__), phrase, owner))
        close = []
        if near:
            for k, words in enumerate(packed["words"]):
                present = [w for w in set(words.tolist()) if w in rank]  # an altered copy has lost some words
                if present:
                    close.append((k, sorted(present, key=lambda w: (rank[w], w))[:NEAR_TERMS]))
        names = ["" if i is None else str(i) for i in packed["items"]]
        for batch in batches:
            for k, row in enumerate(arrays(batch, _ARRAYS)):
                yield _match_shard(row | {c: batch.column(c)[k].as_py() for c in ("shard", "docs", "first")}, plans, close, names)

    return run


def _match_shard(row, plans, close, names) -> pa.RecordBatch:
    words, ends, places = (row[c] for c in _ARRAYS)
    first = np.asarray(row["first"], np.int64)
    found: dict[int, np.ndarray] = {}

    def postings(word: int) -> np.ndarray:
        if word not in found:
            at = int(np.searchsorted(words, np.uint64(word)))
            hit = at < len(words) and int(words[at]) == word
            found[word] = places[ends[at - 1] if at else 0:ends[at]].astype(np.int64) if hit else np.zeros(0, np.int64)
        return found[word]

    starts, widths, owners = [], [], []
    for order, phrase, owner in plans:
        here = postings(int(phrase[order[0]])) - order[0]
        for k in order[1:]:
            if not len(here):
                break
            listed = postings(int(phrase[k]))
            at = np.searchsorted(listed, here + k)
            at[at == len(listed)] = 0
            here = here[listed[at] == here + k] if len(listed) else here[:0]
        if len(here):
            doc = np.searchsorted(first, here, "right") - 1
            inside = (here >= 0) & (here + len(phrase) <= first[np.minimum(doc + 1, len(first) - 1)])
            here = here[inside]
            starts.append(here)
            widths.append(np.full(len(here), len(phrase)))
            owners.append(np.full(len(here), owner))
    n_docs = len(row["docs"])
    items: list[list[str]] = [[] for _ in range(n_docs)]
    runs: list[list] = [[] for _ in range(n_docs)]
    if starts:
        start, width, owner = map(np.concatenate, (starts, widths, owners))
        order = np.argsort(start, kind="stable")
        start, width, owner = start[order], width[order], owner[order]
        doc = np.searchsorted(first, start, "right") - 1
        for d in np.unique(doc).tolist():
            own = doc == d
            items[d] = [names[k] for k in set(owner[own].tolist())]
            runs[d] = [{"a": a - int(first[d]), "b": b - int(first[d])} for a, b in _runs(start[own], width[own])]
    return pa.RecordBatch.from_arrays([
        pa.array([row["shard"]] * n_docs, pa.int64()), pa.array(range(n_docs), pa.int32()),
        pa.array(row["docs"], pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(items, pa.list_(pa.string())),
        pa.array(runs, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
        pa.array(_near(first, n_docs, close, names, postings), pa.list_(pa.string()))],
        names=["shard", "row", "doc_id", "n_words", "items", "runs", "near"])


def _near(first, n_docs, close, names, postings) -> list[list[str]]:
    """Items whose rarest terms all stand within NEAR_SPAN words of the rarest one, inside one document."""
    out: list[list[str]] = [[] for _ in range(n_docs)]
    for k, terms in close:
        here = postings(terms[0])
        for term in terms[1:]:
            if not len(here):
                break
            listed = postings(term)
            doc = np.searchsorted(first, here, "right") - 1
            low, high = np.maximum(here - NEAR_SPAN, first[doc]), np.minimum(here + NEAR_SPAN + 1, first[doc + 1])
            here = here[np.searchsorted(listed, high) > np.searchsorted(listed, low)]
        for d in np.unique(np.searchsorted(first, here, "right") - 1).tolist():
            out[d].append(names[k])
    return out


def _term_counts(index: DataFrame, wanted):
    """Occurrences in the whole corpus of the words of one block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = wanted.value
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for row in arrays(batch, {c: _ARRAYS[c] for c in ("words", "ends")}):
                words = row["words"]
                if len(words):
                    sizes = np.diff(row["ends"].astype(np.int64), prepend=0)
                    at = np.minimum(np.searchsorted(words, terms), len(words) - 1)
                    total += np.where(words[at] == terms, sizes[at], 0)
        keep = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(total[keep], pa.int64())], names=["term", "n"])

    return index.select("words", "ends").mapInArrow(settled(run), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def phrase_matches(index: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                   window: int = WINDOW, near: bool = True) -> DataFrame:
    """One row per document: its words, the items found, merged hit runs (per block) and near items."""
    context = index.sparkSession.sparkContext
    parts = []
    for block in _item_blocks(benchmark, id_col, text_col, window):
        terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *block["words"]]))
        counted = _term_counts(index, context.broadcast(terms)).collect()  # at most BLOCK_WORDS rows
        counts = {int(terms[r["term"]]): r["n"] for r in counted}
        parts.append(index.mapInArrow(settled(_matcher(context.broadcast(block), context.broadcast(counts), near)), MATCH))
    if not parts:
        nothing = {"phrases": [], "owner": [], "words": [], "items": []}
        parts.append(index.mapInArrow(settled(_matcher(context.broadcast(nothing), context.broadcast({}), near)), MATCH))
    if len(parts) == 1:
        return parts[0]
    # one row per document and block: a document's rows are as many as the benchmark has blocks
    return reduce(DataFrame.unionByName, parts).groupBy("shard", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("items", "runs", "near")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", window: int = WINDOW, near: bool = True) -> DataFrame:
    """Per document: n_words, n_hit, n_items, item ids, hit runs, n_near, near items and the contaminated flag."""
    found = phrase_matches(build_index(docs, id_col), benchmark, window=window, near=near)
    covered = F.expr("""aggregate(array_sort(runs), named_struct('n', 0L, 'e', 0L),
        (s, r) -> named_struct('n', s.n + greatest(0L, r.b - greatest(r.a, s.e)), 'e', greatest(s.e, r.b)), s -> s.n)""")
    return found.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.array_sort("items").alias("items"), "runs", F.size("near").cast("bigint").alias("n_near"), "near",
    ).withColumn("contaminated", F.col("n_hit") > 0)
