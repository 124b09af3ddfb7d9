"""Bag search, spelling variants and packing against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import corpus, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakekit.llm import bag_search, packing, spelling

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


# ---- ranked search over bags

def search_brute(rows, items, top):
    docs = [(k, doc, Counter(TERM.findall(lower(t)))) for k, (doc, t) in enumerate(rows)]
    total = sum(1 for *_, c in docs if c)
    words = sum(sum(c.values()) for *_, c in docs)
    df = Counter(w for *_, c in docs for w in c)
    out = []
    for item, text in items:
        found = []
        for k, doc, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * total) // max(words, 1)
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                        for w in set(TERM.findall(lower(text))) if w in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:top])]
    return out


def as_set(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("terms,cells", [(1 << 19, 1 << 22), (30, 50)])
def test_bag_search(spark, monkeypatch, terms, cells):
    monkeypatch.setattr(bag_search, "BLOCK_TERMS", terms)
    monkeypatch.setattr(bag_search, "CELLS", cells)
    rng = random.Random(4)
    rows = corpus(4, 60)
    long_texts = [t for _, t in rows if t and len(t.split()) > 20]
    rows += [(None, long_texts[0]), (None, "one"), (3, long_texts[0]), *((700 - i, "same words here Ünder 7up") for i in range(30)), (2000, long_texts[1].upper())]
    rng.shuffle(rows)
    items = [(k, " ".join(rng.choice(long_texts).split()[k:k + 9])) for k in range(8)]
    items += [(20, "HERE here 7UP"), (21, None), (22, ""), (23, "..."), (24, "absent"), (8, "one two"), (8, "one two"), (None, "Ünder É")]
    asked = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id bigint, text string, item bigint, score bigint")
    got = bag_search.search(frame(spark, rows, 3), asked)
    assert as_set(tuple(r) for r in got.collect()) == as_set(search_brute(rows, items, 10))
    few = bag_search.search(frame(spark, rows, 3), asked, top=3).collect()
    assert as_set(tuple(r) for r in few) == as_set(search_brute(rows, items, 3))


def test_bag_search_sql_and_empty_tables(spark):
    rows = [r for r in corpus(5, 40) if r[1]]
    items = [(k, t) for k, (_, t) in enumerate(rows[:20])]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    con.register("benchmark", pa.table({"item_id": [r[0] for r in items], "text": [r[1] for r in items]}))
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert as_set(tuple(r) for r in bag_search.search(frame(spark, rows), asked).collect()) == as_set(con.execute(bag_search.oracle_sql()).fetchall())
    assert bag_search.search(frame(spark, []), asked).collect() == []
    assert bag_search.search(frame(spark, rows), asked.limit(0)).collect() == []


def test_scores_are_exact_integers():
    block = bag_search.Block(np.zeros(3000, np.int64), np.arange(3000, dtype=np.uint64))
    block.weights[:] = 39_999
    every = np.arange(3000)
    got = bag_search.score_classes(block, np.zeros(3000, np.int64), every, every + 10**6, np.array([10]))
    assert got[0, 0] == sum(39_999 * (10**9 * c // (1000 * c + 80)) for c in (every + 10**6).tolist())


# ---- spelling variants

def words_brute(rows):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def apart_by_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def forms_brute(counts):
    near = {w: [x for x in counts if apart_by_one(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root))
    return out


def test_group_spellings(spark, monkeypatch):
    rng = random.Random(6)
    stems = ["".join(rng.choice("abeÀÿx") for _ in range(rng.randint(4, 9))) for _ in range(60)]

    def typo(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abÀz") + w[i:], w[:i] + rng.choice("abÀz") + w[i + 1:], w, w, w, w.upper()])

    rows = [(i, " ".join(typo(rng.choice(stems)) for _ in range(120)) + "×÷ it's") for i in range(40)]
    rows += [(None, "Wording wording9wording_WORDING"), (None, "wordings " * 9), (7, rows[3][1]), (8, None), (9, ""), (10, "a" * 500 + " " + "aaaaa " * 5)]
    want = forms_brute(words_brute(rows))
    assert len(want) > 150 and sum(1 for r in want if r[3]) > 30
    for held, piece in ((300_000, 1 << 20), (50, 64)):
        monkeypatch.setattr(spelling, "HELD", held)
        monkeypatch.setattr(spelling, "SLICE", piece)
        got = spelling.group_spellings(frame(spark, rows, 3)).select("word", "n", "n_near", "form", "form_n", "root").collect()
        assert as_set(tuple(r) for r in got) == as_set(want)
    assert spelling.group_spellings(frame(spark, [])).collect() == []
    assert spelling.group_spellings(frame(spark, [(1, None), (2, "abc abc abc")])).collect() == []


def test_long_chains_and_dense_words(spark):
    counts = {"b" * k: 3 * 2**(k - 5) for k in range(5, 40)}  # each a form of the one before
    counts |= {"".join(x): 5 for x in ("ababa", "babab", "aaaab", "baaaa", "ababab", "aabab", "ababb")}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = spelling.variant_forms(words).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert as_set(tuple(r) for r in got) == as_set(forms_brute(counts))


def test_spelling_broadcasts_no_words(spark, monkeypatch):
    """Keys are dozens of rows a word, which Spark sizes as the words' own small table."""
    plans, real = [], spelling.cut_lineage
    table = real(spark.createDataFrame([("words", 9), ("wordz", 3), ("other", 4)], "word string, n bigint"))
    monkeypatch.setattr(spelling, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().toString()) or real(df))
    forms = spelling.variant_forms(table)
    plans.append(forms._jdf.queryExecution().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("BroadcastHashJoin" in p or "BroadcastNestedLoopJoin" in p for p in plans)
    assert sorted((r.word, r.n_near, r.form, r.root) for r in forms.collect()) == [("other", 0, None, "other"), ("words", 1, None, "words"), ("wordz", 1, "words", "words")]


def test_near_words_of_a_small_alphabet(spark):
    rng = random.Random(9)
    counts = {"".join(rng.choice("abcÀÿ") for _ in range(rng.randint(5, 8))): rng.randint(3, 90) for _ in range(1500)}
    shorter = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1:], i].add(w)
    want = {(w, x) for key, group in shorter.items() for w in group for x in group if w != x}
    want |= {p for (s, _), group in shorter.items() if s in counts for w in group for p in ((s, w), (w, s))}
    got = spelling.near_words(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()
    assert len(got) == len(want) and {(r.word, r.near) for r in got} == want
    assert all(r.n == counts[r.word] and r.near_n == counts[r.near] for r in got)


@pytest.mark.parametrize("scale", [1, 10**10])
def test_pivots_cost_least(scale):
    rng = random.Random(2)
    words = spelling.Words(["".join(rng.choice("abcd") for _ in range(rng.randint(5, 12))) for _ in range(300)])
    counts = np.bincount(words.gram, minlength=spelling.GRAMS) * scale
    rank = np.empty(spelling.GRAMS, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(spelling.GRAMS)
    word, place, last = spelling.prefix_grams(words, rank)
    at = words.begins[word] + place
    gram = words.letters[at] * spelling.LETTERS + words.letters[at + 1]
    one, two = spelling.pivots(word, place, counts[gram])
    for w in range(300):
        own = [(p, counts[g]) for p, g in zip(place[word == w], gram[word == w])]
        cost = dict(own)
        assert len(own) >= 3 and two[w] - one[w] >= 2
        assert cost[one[w]] + cost[two[w]] == min(a + b for p, a in own for q, b in own if q - p >= 2)


# ---- packing

def texts_of(seed):
    extra = [(900, "a  b\n c   d \n\n e "), (901, "<|endoftext|> x <|"), (902, "ñ  ñ it's don't '' 12 3x4"), (903, " lead"), (904, "a\x1c b\x85 c\xa0 d\t\t e"),
             (905, "x " * 1100), (None, "one two"), (3, "again"), (906, "word, word. (word) 'll 's"), (907, "漢字 😀 " * 9)]
    return corpus(seed, 60) + extra


def test_packing_round_trip(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_CHARS", 500)
    rows = texts_of(7)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = sorted((repr(d), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t in rows)
    packed = packing.pack(frame(spark, rows, 4).drop("n_chars"), BYTE_BPE, cap=64).cache()
    got = packed.collect()
    # pieces make up the documents again
    rebuilt, parts = [], defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"] <= 64 and (r["piece"] == 0 or r["length"] == 64)
        parts[repr(r.doc_id)].append((r.start, r.piece, tuple(np.frombuffer(r["ids"], np.uint32).tolist())))
    for doc, ids in want:
        place = 0
        while place < len(ids):
            k = next(k for k, p in enumerate(parts[doc]) if p[0] == place and p[2] == ids[place:place + len(p[2])])
            place += len(parts[doc].pop(k)[2])
        rebuilt.append(doc)
    assert len(rebuilt) == len(rows) and not any(parts.values())
    # sequences are gapless and short, and few
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r["length"], r["ids"]))
    for own in held.values():
        own.sort()
        assert [o for o, *_ in own] == [sum(n for _, n, _ in own[:k]) for k in range(len(own))] and sum(n for _, n, _ in own) <= 64
    assert len(held) <= -(-sum(r["length"] for r in got) // 64) + 1
    whole = {r.sequence_id: (r["ids"], [(s.offset, s.length) for s in r.spans]) for r in packing.sequences(packed).collect()}
    assert whole == {s: (b"".join(bytes(i) for *_, i in own), [(o, n) for o, n, _ in own]) for s, own in held.items()}
    packed.unpersist()


def test_packing_digest_and_empty_tables(spark):
    rows = texts_of(8)
    got = packing.digest(spark, frame(spark, rows, 2), BYTE_BPE).collect()
    plain = packing.pack(frame(spark, rows, 2), BYTE_BPE).collect()
    assert sorted((r.length, r.ids_crc32) for r in got) == sorted((r["length"], zlib.crc32(r["ids"])) for r in plain)
    assert packing.digest(spark, frame(spark, []), BYTE_BPE).collect() == []


@pytest.mark.parametrize("room", [1, 1 << 20])
def test_word_encoder_equals_tokenizer(monkeypatch, room):
    monkeypatch.setattr(packing, "ROOM", room)
    rng = random.Random(11)
    signs = "aé ñZ 1\n'.,-×s<|\t\x1c\xa0ſ漢"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [t or "" for _, t in texts_of(9)]
    encoder, tokenizer = packing.WordEncoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for lo, hi in packing._slices(texts):
        ids, sizes = encoder.encode(texts[lo:hi])
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[lo:hi]]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


PATTERN = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[^ \nA-Za-z0-9À-ÖØ-öø-ɏ]+|[ \n]+(?![^ \n])|[ \n]+")


def test_words_are_those_of_the_pattern():
    rng = random.Random(12)
    texts = ["".join(rng.choice(["a", "é", "ñ", "Z", "1", " ", " ", "\n", "'", "'s", "'re", "'ll", ".", "×"]) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, odd = packing.cut_words(data, offsets)
    want = [w.encode() for t in texts for w in PATTERN.findall(t)]
    assert not len(odd) and [data[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(data)))] == want
    texts = ["tab\t", "fine", "", "<|x|>", "\u0250", "漢", "also fine", "\x7f"]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    assert packing.cut_words(data, offsets)[1].tolist() == [0, 3, 4, 5, 7]


def test_new_words_do_not_meet_the_tokenizers_pattern():
    texts = [" one two, né 'tis it's 12\n", None, "two Three" * 3]
    tokenizer, encoder = Tokenizer.from_file(BYTE_BPE), packing.WordEncoder(BYTE_BPE)
    asked = []
    one_by_one = encoder._ids
    encoder._ids = lambda text: asked.append(text) or one_by_one(text)
    ids, sizes = encoder.encode(pa.array(texts))
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]
    assert asked == ["\n"]  # white space alone


def brute_bin(left, cap):
    used, gap = Counter(), cap
    while True:
        fits = [n for n in left if left[n] - used[n] > 0 and n <= gap]
        if not fits:
            break
        used[max(fits)] += 1
        gap -= max(fits)
    rest = sorted((n for n in left for _ in range(min(left[n] - used[n], 2))), reverse=True)
    least = min(used)
    best = max(((a + b, a, b) for i, a in enumerate(rest) for b in rest[i + 1:] if a + b <= gap + least), default=(0,))
    if best[0] > least:
        used[least] -= 1
        used[best[1]] += 1
        used[best[2]] += 1
    return {n: k for n, k in used.items() if k}


def test_bins_are_best_two_fit():
    rng = random.Random(5)
    for _ in range(200):
        cap = rng.choice([10, 37, 100])
        counts = np.bincount([min(cap, 1 + int(rng.paretovariate(0.6))) if rng.random() < 0.5 else rng.randint(cap // 4, cap)
                              for _ in range(rng.randint(1, 60))], minlength=cap + 1)
        got = packing.fill_bin(counts, cap)
        assert {n: int(k) for n, k in enumerate(got) if k} == brute_bin({n: int(k) for n, k in enumerate(counts) if k}, cap)
        rows = packing.plan_bins(counts, cap)
        given = Counter()
        filled = defaultdict(int)
        for length, first, n, each, sequence, at in rows:
            assert first == given[length]
            given[length] += n
            for s in range(sequence, sequence + n // each):
                assert filled[s] == at
                filled[s] += each * length
        assert {n: int(k) for n, k in enumerate(counts) if k} == dict(given) and max(filled.values()) <= cap
        assert len(packing.plan_bins(counts * 10**9, cap)) <= 40 * len(counts)  # the plan does not grow with the corpus


def test_packing_numbers_pieces_over_tasks(spark):
    rows = [(i, "same") for i in range(500)]
    got = packing.digest(spark, frame(spark, rows, 7), BYTE_BPE)
    per = got.groupBy("sequence_id").agg(F.count("*").alias("k"), F.max(F.col("offset") + F.col("length")).alias("end"), F.countDistinct("offset").alias("d"))
    assert per.where("k <> d or end > 1024").count() == 0 and per.agg(F.sum("k")).first()[0] == 500 and per.count() == 1
