"""Spelling variants: words one edit apart, found by pivotal grams.

`count_words` cuts texts into runs of letters, spoils a known share of them (see `spoil`) and counts the results over all
documents. `near_words` finds all pairs of words that differ by exactly one inserted, deleted or replaced code point:

1. Bigrams are ordered by the number of words' places that hold them, rare first. A word's prefix is its
   three rarest bigrams, and all places of the third. One edit spoils two bigrams at most, and of two disjoint ones only one.
2. Two disjoint bigrams of the prefix, of the least total count, are the word's pivots, chosen by dynamic programming over
   places. Of two near words, the one whose prefix ends earlier in the order has a pivot that the other's prefix holds,
   at the same place counted from the start (the edit comes after it) or from the end (before it).
3. Pivots are looked up in the index of prefixes by that place and the lengths. As the edit lies to one side of
   the pivot, the other side is equal, and so is one half of the edit's side; both are part of the index key.
   Candidates then are few, whatever the number of words with the same rare bigram.
4. Edit distance decides, on the words themselves, within the join.

`variant_forms` gives each word its near words' number, its form (the near word of largest count, ties by smallest in code-point order,
if that count is at least twice its own) and its root, the end of the chain of forms. Each form has at least twice the
count, so a chain is no longer than the count's bits and pointer doubling ends after a known number of rounds.

Null and empty texts have no words; a null id counts as an empty one in the spoiling rule. Repeated rows count again. Very long
texts are read in slices that end between words. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrays import BYTE_VALUES, mix, powers, ragged
from lakekit.session import cut_lineage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
EVERY = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
SLICE = 1 << 20
HELD = 300_000  # words a task counts before it hands them on

LETTERS = 26 + 64  # a-z and the code points C0 to FF
GRAMS = LETTERS * LETTERS
SIDES = "key bigint, word string, n bigint, last int"


def spoil(word: str, prefix: int) -> str:
    """The word without one code point if EVERY divides the checksum of id, colon and word; `prefix` is that of id and colon."""
    h = zlib.crc32(word.encode(), prefix)
    if h % EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _runs(text: str) -> Iterator[list[str]]:
    """Lists of runs of letters, A-Z lower-cased."""
    text = text.encode().lower().decode()
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and RUN.match(text, end):
            end += 1
        yield RUN.findall(text, at, end)
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
        total.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for runs in _runs(text):
                for run, n in Counter(runs).items():
                    word = spoil(run, prefix)
                    if len(word) >= LEAST_LENGTH:
                        total[word] += n
            if len(total) > HELD:
                yield rows()
    yield rows()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of at least LEAST_LENGTH code points and LEAST_COUNT occurrences."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Words:
    """A batch of words as one array of letters: `lengths`, where each `begins`, and the bigram at every place but the last."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.letters = np.where(points < 128, points - 97, points - 0xC0 + 26)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.begins = np.cumsum(self.lengths) - self.lengths
        counts = np.maximum(self.lengths - 1, 0)
        self.word = np.repeat(np.arange(len(words)), counts)
        at = ragged(self.begins, counts)
        self.place = at - self.begins[self.word]
        self.gram = self.letters[at] * LETTERS + self.letters[at + 1]
        self.hash = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[self.letters] * powers(len(points)), out=self.hash[1:])

    def span(self, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        a, b = self.begins[word] + start, self.begins[word] + end
        return mix((self.hash[b] - self.hash[a]) * powers(len(self.hash), inverse=True)[a])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(GRAMS, np.int64)
    for batch in batches:
        total += np.bincount(Words(batch.column(0).to_pylist()).gram, minlength=GRAMS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["gram", "n"])


def prefix_grams(words: Words, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grams of all prefixes in order of word and place: word, place; and per word the rank its prefix ends with."""
    order = np.lexsort((words.place, rank[words.gram], words.word))
    word, place, ranks = words.word[order], words.place[order], rank[words.gram[order]]
    first = np.searchsorted(word, np.arange(len(words.lengths)))
    last = ranks[first + 2]
    keep = ranks <= last[word]
    word, place = word[keep], place[keep]
    order = np.lexsort((place, word))
    return word[order], place[order], last


def pivots(word: np.ndarray, place: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word the places of its two disjoint prefix grams of the least total cost.

    Grams come by word and place. Step one: the cheapest gram that ends before a place; step two: the cheapest
    end of such a pair."""
    n = len(word)
    index = np.arange(n)
    far = int(cost.max(initial=0)) * 2 + 1
    # keys fall from word to word, so a running minimum starts anew with each; the place rides along, costs by their order
    level, bits = np.unique(cost, return_inverse=True)[1], max(n, 1).bit_length()
    best = np.minimum.accumulate(((level - word * GRAMS) << bits) + index)
    before = index - np.where((index > 0) & (np.roll(place, 1) == place - 1) & (np.roll(word, 1) == word), 2, 1)
    there = before >= 0
    there[there] &= word[before[there]] == word[there]
    partner = np.where(there, best[before] & ((1 << bits) - 1), 0)
    total = np.where(there, cost + cost[partner], far)
    order = np.lexsort((index, total, word))
    second = order[np.searchsorted(word, np.unique(word))]
    return place[partner[second]], place[second]


def _keys(words: Words, word: np.ndarray, at: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, keys) under which the gram at place `at` of each word meets the pivot of a word of length `other`: by what is equal
    if the edit lies in the later or earlier half of what follows the pivot, or of what precedes it."""
    length = words.lengths[word]
    zero = np.zeros_like(at)

    def key(case: int, pivot: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(a ^ mix(b + (other.astype(np.uint64) << np.uint64(32)) + (pivot.astype(np.uint64) << np.uint64(3)) + np.uint64(case)))

    after = other - at - 2  # the pivot stands at the same place from the start
    near, ok = after // 2, after >= 0
    rows = np.flatnonzero(ok & (at + 2 + near <= length))
    yield rows, key(0, at, words.span(word, zero, np.minimum(at + 2 + near, length)), np.uint64(0))[rows]
    tail = length - (after - near)
    rows = np.flatnonzero(ok & (tail >= at + 2))
    tail = np.clip(tail, 0, length)
    yield rows, key(1, at, words.span(word, zero, at + 2), words.span(word, tail, length))[rows]
    pivot = at + other - length  # the pivot stands at the same place from the end
    near, ok = pivot // 2, pivot >= 0
    rows = np.flatnonzero(ok & (at - (pivot - near) >= 0))
    yield rows, key(2, pivot, words.span(word, np.clip(at - (pivot - near), 0, length), length), np.uint64(0))[rows]
    rows = np.flatnonzero(ok & (near <= at))
    yield rows, key(3, pivot, words.span(word, zero, np.clip(near, 0, length)), words.span(word, at, length))[rows]


def _sides(counts: np.ndarray, rank: np.ndarray, probe: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = Words(batch.column(0).to_pylist())
            word, place, last = prefix_grams(words, rank)
            if probe:
                gram = words.letters[words.begins[word] + place] * LETTERS + words.letters[words.begins[word] + place + 1]
                one, two = pivots(word, place, counts[gram])
                word, place = np.tile(np.arange(len(one)), 2), np.concatenate([one, two])
            for step in (0,) if probe else (-1, 0, 1):
                for rows, key in _keys(words, word, place, words.lengths[word] + step):
                    own = pa.array(word[rows])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0).take(own), batch.column(1).take(own),
                                                      pa.array(last[word[rows]], pa.int32())], names=["key", "word", "n", "last"])

    return run


def near_words(words: DataFrame) -> DataFrame:
    """All ordered pairs (word, n, near, near_n) of words one edit apart."""
    counts = np.zeros(GRAMS, np.int64)
    for row in words.select("word").mapInArrow(_gram_counts, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] = row["n"]  # GRAMS rows at most
    rank = np.empty(GRAMS, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(GRAMS)
    plain = words.select("word", "n")
    # dozens of rows a word, which Spark sizes as the words themselves; no side goes through the driver
    probes = plain.mapInArrow(_sides(counts, rank, True), SIDES).hint("merge").alias("u")
    index = plain.mapInArrow(_sides(counts, rank, False), SIDES).hint("merge").alias("v")
    met = probes.join(index, F.expr("u.key = v.key and u.last <= v.last and u.word <> v.word")).where(F.expr("levenshtein(u.word, v.word, 1) = 1"))
    pairs = cut_lineage(met.selectExpr("u.word AS word", "u.n AS n", "v.word AS near", "v.n AS near_n").distinct())
    return pairs.union(pairs.select("near", "near_n", "word", "n")).distinct()


def variant_forms(words: DataFrame) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    found = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = F.expr("-best.m >= 2 * n")
    rows = cut_lineage(words.select("word", "n").join(found.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n")))
    largest = rows.agg(F.max("form_n")).first()[0] or 0
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(int(largest).bit_length() - 1, 0).bit_length()):  # a chain has fewer steps than its last count has bits
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = cut_lineage(roots.join(step.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return rows.join(roots.hint("merge"), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def group_spellings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`variant_forms` of all words of the documents."""
    return variant_forms(cut_lineage(count_words(docs, id_col, text_col)))
