"""Joins and dedup operators against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import corpus, frame

from lakekit.llm import jaccard_join, line_join, suffix_dedup, linking


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text, width):
    w = [x for x in re.split("[\x20\x09-\x0d]+", fold(text or "")) if x]
    if not w:
        return set()
    return {tuple(w)} if len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def jaccard_brute(rows, width, num, den):
    sets = {i: shingle_set(t, width) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    root = components(sets, links)
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("seed,width,num", [(1, 4, 85), (3, 2, 60)])
def test_jaccard_classes(spark, seed, width, num):
    rows = corpus(seed, 110)
    got = jaccard_join.similar_classes(frame(spark, rows), width, num, 100).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_brute(rows, width, num, 100)


@pytest.mark.parametrize("few", [500_000, 0])
def test_jaccard_chains_near_the_threshold(spark, monkeypatch, few):
    """Each copy differs a little more from the first, so classes need links between neighbours. Pairs are verified in parts."""
    monkeypatch.setattr(linking, "PAIRS", 20)
    monkeypatch.setattr(linking, "PARTS", 2)
    monkeypatch.setattr(linking, "FEW", few)
    rng = random.Random(5)
    rows, text = [], [f"t{rng.randrange(10 ** 6)}" for _ in range(120)]
    for i in range(60):
        rows.append((i, " ".join(text)))
        text[rng.randrange(120)] = f"u{i}"
    rng.shuffle(rows)
    got = jaccard_join.similar_classes(frame(spark, rows), 4, 85, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_brute(rows, 4, 85, 100)


def test_jaccard_odd_rows(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "A B C D E F"), (4, None), (5, "")]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard_join.similar_classes(frame(spark, rows), 4, 85).collect())
    assert got == [(-1, 3, None), (3, 3, 3), (3, 3, 3), (4, 0, 4), (5, 0, 5), (9, 3, 3)]
    assert jaccard_join.similar_classes(frame(spark, [])).collect() == []


def test_jaccard_ids_with_several_texts(spark):
    """An id stands for all its texts: one that equals another id's text doesn't hide the others."""
    rng = random.Random(8)
    one, two = ([f"{k}{rng.randrange(10 ** 6)}" for _ in range(80)] for k in "ab")
    near = [*one[:79], "other"]
    rows = [(3, " ".join(two)), (5, " ".join(one)), (5, " ".join(two)), (7, " ".join(one)), (9, " ".join(near)), (9, "else"), (11, "else where")]
    got = {(r.doc_id, r.component_id) for r in jaccard_join.similar_classes(frame(spark, rows)).collect()}
    assert got == {(3, 3), (5, 3), (7, 3), (9, 3), (11, 11)}


@pytest.mark.parametrize("num", [80, 85])
def test_linked_sets_share_a_probe(num):
    """Sets at the threshold, in one band or in neighbouring ones, meet where one is at home and one probes."""
    bands, rng, across = jaccard_join.bands_of(num, 100), np.random.default_rng(num), 0
    for _ in range(300):
        n = int(rng.integers(5, 900))
        values = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        lost = int(rng.integers(0, n * (100 - num) // 100 + 1))
        added = max(((n - lost) * 100 - num * n) // num, 0)
        other = np.unique(np.concatenate([rng.permutation(values)[lost:], rng.integers(0, 1 << 63, added).astype(np.uint64)]))
        every, rows = np.concatenate([values, other]), np.array([0, n, n + len(other)])
        sizes, listed = np.diff(rows), [{}, {}]
        for role in (0, 1):
            band = bands.of(sizes) + role
            use = (bands.apart[band] > 0) & ((role == 0) | (100 * sizes >= num * bands.starts[band]))
            for sig, row, flag in zip(*(x.tolist() for x in jaccard_join._parts(every, rows, use, band, bands, jaccard_join.OWN if role == 0 else 0))):
                listed[row][sig] = listed[row].get(sig, 0) | flag
        both = [listed[0][s] | listed[1][s] for s in listed[0].keys() & listed[1].keys()]
        assert lost + added == 0 or any(f & jaccard_join.OWN and f & jaccard_join.PROBE for f in both)
        across += bands.of(sizes)[0] != bands.of(sizes)[1]
    assert across > 20


def test_one_deletion_neighbourhoods_meet():
    """A set with too few filled segments lists its parts without each one shingle."""
    bands = jaccard_join.bands_of(85, 100)
    rng = np.random.default_rng(1)
    found = 0
    for _ in range(400):
        # crowd the shingles into few segments
        values = np.unique((rng.integers(0, 1 << 28, 8).astype(np.uint64) << np.uint64(32)) % np.uint64(1 << 61))
        less = np.delete(values, 3)
        every, rows = np.concatenate([values, less]), np.array([0, len(values), len(values) + len(less)])
        band = np.full(2, bands.of(np.array([len(values)]))[0])
        sig, row, flag = jaccard_join._parts(every, rows, np.ones(2, bool), band, bands, 1)
        found += bool(set(sig[(row == 0)].tolist()) & set(sig[(row == 1)].tolist()))
    assert found == 400


def repeats_brute(texts, win):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + win] for r in raw for i in range(len(r) - win + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - win + 1):
            if seen[r[i:i + win]] > 1:
                gone[i:i + win] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def suffix_rows(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.runs), hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


@pytest.mark.parametrize("seed,win,gram,group", [(1, 200, 64, 4000), (3, 40, 12, 2)])
def test_repeats_removed(spark, seed, win, gram, group):
    rows = corpus(seed, 70)
    want = sorted((i, *x) for (i, _), x in zip(rows, repeats_brute([t for _, t in rows], win)))
    assert suffix_rows(suffix_dedup.remove_repeats(frame(spark, rows), win, gram, group)) == want


def test_repeats_in_low_entropy_text(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 400))) for _ in range(30)] + ["a" * 100, "a" * 31, "ba" * 40, "a" * 30 + "b"]
    rows = list(enumerate(texts))
    want = sorted((i, *x) for i, x in enumerate(repeats_brute(texts, 12)))
    assert suffix_rows(suffix_dedup.remove_repeats(frame(spark, rows), 12, 5)) == want


def test_repeats_odd_rows(spark):
    rows = [(1, "q" * 10 + "z" * 240), (1, "q" * 10 + "z" * 240), (2, None), (2, "")]
    got = suffix_rows(suffix_dedup.remove_repeats(frame(spark, rows)))
    empty = hashlib.sha256(b"").hexdigest()
    assert got == [(1, 250, 250, 1, empty)] * 2 + [(2, 0, 0, 0, empty)] * 2
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []
    assert suffix_dedup.remove_repeats(frame(spark, [(None, "x")])).first().doc_id is None


def test_two_stage_order_is_the_suffix_order():
    rng = random.Random(9)
    for alphabet in (b"ab", b"abc", bytes(range(256))):
        parts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(8)]
        data, order, part = suffix_dedup.sort_starts(parts, [len(p) for p in parts], 1000)
        ends = np.cumsum([len(p) for p in parts])
        keys = [data.tobytes()[i:ends[part[i]]] for i in order.tolist()]
        assert keys == sorted(keys) and len(keys) == len(data)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text) + 1)
        text = rng.choice([text[:i] + rng.choice("abé") + text[i:], text[:i] + text[i + 1:], text[:i] + "x" + text[i + 1:]])
    return text


def test_banded_distance():
    rng = random.Random(4)
    for limit in (0, 1, 2, 3, 5):
        for _ in range(400):
            a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
            b = edited(rng, a, rng.randint(0, 7))
            assert line_join.within(a, b, limit) == (distance(a, b) <= limit), (a, b, limit)


@pytest.mark.parametrize("seed,limit", [(1, 2), (3, 3)])
def test_line_dedup(spark, seed, limit):
    rng, short = random.Random(seed), 8
    lines = ["", " ", "tiny", "tiny", "tinx"]
    while len(lines) < 150:
        text = "".join(rng.choice("abcdéß ") for _ in range(rng.randint(0, 30)))
        lines.append(edited(rng, rng.choice(lines), rng.randint(0, limit + 1)) if rng.random() < 0.5 else text)
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 6:i * 6 + 6])) for i in range(25)] + [(90, None), (91, ""), (92, "\n")]
    every = [(i, k, x) for i, t in rows if t is not None for k, x in enumerate(t.split("\n"))]
    ids = range(len(every))
    wordy = [n for n in ids if every[n][2].strip(" ")]
    links = [(a, b) for a in wordy for b in wordy if a < b and (every[a][2] == every[b][2] or (
        min(len(every[a][2]), len(every[b][2])) >= max(short, limit + 1) and distance(every[a][2], every[b][2]) <= limit))]
    root = components(ids, links)
    want = {}
    for i, t in rows:
        own = [n for n in ids if every[n][0] == i]
        stay = [every[n][2] for n in own if root[n] == n]
        want[i] = (len(own), len(own) - len(stay), None if t is None else "\n".join(stay))
    got = line_join.drop_lines(frame(spark, rows), limit, short).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in got} == want
    assert len(got) == len(rows)


def test_line_dedup_odd_rows(spark):
    line = "a line that is long enough to count"
    got = line_join.drop_lines(frame(spark, [(1, line), (1, line), (None, line + "!"), (7, "own\n" + "z" * 50_000)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 1), (1, 1), (7, 0)]
    assert line_join.drop_lines(frame(spark, [])).collect() == []


def test_near_copies_of_a_line_are_not_all_paired(spark, monkeypatch):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(24)]
    lines = []
    for _ in range(60):
        own = list(base)
        own[rng.randrange(24)] = "".join(rng.choice("qrstuvwxyz") for _ in range(9))
        lines.append(" ".join(own))
    pairs, links = [], linking._links
    monkeypatch.setattr(linking, "_links", lambda found, *rest: pairs.append(found.count()) or links(found, *rest))
    plain, both = line_join.line_values, line_join.line_values(0).copy()
    both[ord("b")] = both[ord("a")]
    monkeypatch.setattr(line_join, "line_values", lambda salt: plain(salt) if salt else both)  # two lines with one hash: another is taken
    got = line_join.drop_lines(frame(spark, [*enumerate(lines), (60, lines[7] + "!"), (61, "a" * 30), (62, "b" * 30)])).collect()
    assert {r.doc_id for r in got if r.n_removed} == {60}
    assert sum(pairs) < 6 * len(lines)


def test_equal_rows_fill_no_bucket():
    def shared(*batches):
        columns = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["sig", "node", "info"]) for rows in batches]
        return [tuple(r.values()) for b in linking._shared(iter(columns)) for r in b.to_pylist()]

    assert sorted(shared([(1, 5, 3), (1, 5, 3)], [(1, 5, 3), (2, 5, 3)], [(2, 5, 3), (2, 6, 2), (2, 6, 2)])) == [(2, 5, 3), (2, 6, 2)]


@pytest.mark.parametrize("limit", [1, 2])
def test_sketches_of_linked_lines_are_near(limit):
    rng = random.Random(limit)
    pairs = []
    for _ in range(300):
        text = "".join(rng.choice("abcdé😀 ") for _ in range(rng.randint(0, 50)))
        pairs += [text, edited(rng, text, limit)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(pairs)), pa.int64()), pa.array(pairs)], names=["node", "text"])
    rows = [[v for k, v in r.items() if k != "node"] for b in line_join._sketches(iter([batch])) for r in b.to_pylist()]
    for a, b in zip(rows[::2], rows[1::2]):
        assert sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a, b)) <= 4 * limit
