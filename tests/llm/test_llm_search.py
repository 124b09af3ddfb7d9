"""Search, phrase index and pipeline against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from cases import corpus, frame, words
from pyspark.sql import functions as F

import corpus_pipeline
from lakekit.llm import bm25, phrase_index, toxicity

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hits_brute(rows, items, window):
    index = {}
    for item, text in items:
        w = tokens(text)
        width = min(window, len(w))
        for a in range(len(w) - width + 1 if w else 0):
            index.setdefault(tuple(w[a:a + width]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = tokens(text), set(), set()
        for width in {len(x) for x in index}:
            for a in range(len(w) - width + 1):
                own = index.get(tuple(w[a:a + width]))
                if own:
                    found |= own
                    hit |= set(range(a, a + width))
        out.append((doc, len(w), len(hit), sorted("" if i is None else str(i) for i in found)))
    return out


def groups_of(index):
    """Rows, and which columns have statistics, of each row group of a written index."""
    found = []
    for path in index.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:")).metadata
        for group in (meta.row_group(k) for k in range(meta.num_row_groups)):
            found.append((group.num_rows, [group.column(k).path_in_schema for k in range(group.num_columns) if group.column(k).is_stats_set]))
    return found


def large_texts(spark):
    rng = np.random.default_rng(5)
    return frame(spark, [(k, " ".join(map(str, rng.integers(0, 10**9, 100_000)))) for k in range(20)], 1)


def test_phrase_shards_are_written_one_by_one(spark):
    """However many shards a task makes, writers and readers hold a few."""
    index = phrase_index.build_index(large_texts(spark))
    groups = groups_of(index)
    assert len(groups) >= 4 and max(n for n, _ in groups) <= 2 and not any(stats for _, stats in groups)
    assert sorted(d for r in index.select("docs").collect() for d in r.docs) == list(range(20))


def test_bm25_shards_are_written_one_by_one(spark):
    groups = groups_of(bm25.build_index(large_texts(spark)))
    assert len(groups) >= 3 and max(n for n, _ in groups) <= 2 and not any(stats for _, stats in groups)


def test_bm25_tasks_hand_on_the_best_of_all_their_shards():
    """Shards that follow have to reach what a task has found; equal scores go by id, nulls first."""
    texts = [["same words"] * 3 + ["same"], ["same words"] * 2, ["words other", None, "none"]]
    ids = [[5, 3, 9, 1], [4, None], [7, 8, 2]]
    shards = [b for t, i in zip(texts, ids) for b in bm25._index(iter([pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(t, pa.string())], names=["d", "t"])]))]
    query = np.unique(bm25._words(next(bm25.chunks(pa.array(["same words"]))))[0])
    nothing = np.zeros(1, np.uint64)
    block = type("Block", (), {"value": [(11, query, np.array([1.0, 1.0])), (12, nothing, np.ones(1)), (13, query[:1], np.ones(1))]})
    out = [r for b in bm25._searcher(block, 2.0, 3)(iter(shards)) for r in b.to_pylist()]
    assert [(r["q"], r["doc_id"]) for r in out if r["q"] == 11] == [(11, None), (11, 3), (11, 4)]
    assert {r["q"] for r in out} == {11, 13} and sum(r["q"] == 13 for r in out) == 3


def benchmark_of(spark, items):
    return spark.createDataFrame([(*x, 1, 2) for x in items], "item_id bigint, text string, shard bigint, doc_id bigint")


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_decontaminate(spark, monkeypatch, block):
    monkeypatch.setattr(phrase_index, "BLOCK_WORDS", block)
    monkeypatch.setattr(phrase_index, "SHARD_BYTES", 3000)
    rng = random.Random(8)
    rows = corpus(8, 50)
    long_texts = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(k, " ".join(tokens(rng.choice(long_texts))[k:k + rng.randint(3, 25)])) for k in range(12)]
    items += [(20, "One"), (21, None), (22, ""), (23, "..."), (24, "absent wording here"), (25, "x y"), (25, "x y"), (26, "É é ß")]
    # a phrase must not run from one document into the next
    rows += [(900, "alpha beta"), (901, "gamma delta"), (902, "x-y, X.Y x"), (902, None), (None, "one two")]
    items += [(27, "beta gamma")]
    got = phrase_index.decontaminate(frame(spark, rows, 2), benchmark_of(spark, items)).collect()
    want = hits_brute(rows, items, 10)
    as_rows = sorted((str(r.doc_id), r.n_words, r.n_hit, list(dict.fromkeys(r["items"]))) for r in got)
    assert as_rows == sorted((str(d), n, h, i) for d, n, h, i in want)
    assert all(r.contaminated == (r.n_hit > 0) for r in got)


def test_proximity_and_empty_tables(spark):
    items = [(1, "red green blue yellow")]
    rows = [(1, "yellow x x blue x green then red"), (2, "red " + "x " * 60 + "green blue yellow"), (3, "red green")]
    got = {r.doc_id: r.near for r in phrase_index.decontaminate(frame(spark, rows), benchmark_of(spark, items)).collect()}
    assert got == {1: ["1"], 2: [], 3: []}
    assert phrase_index.decontaminate(frame(spark, []), benchmark_of(spark, items)).collect() == []
    none = phrase_index.decontaminate(frame(spark, rows), benchmark_of(spark, [])).collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in none] == [(0, 0, False)] * 3


def test_proximity_passes_over_words_the_corpus_lacks(spark):
    items = [(1, "red green missing blue yellow"), (2, "nowhere found"), (3, "red green blue yellow")]
    rows = [(1, "red green other blue yellow"), (2, "red " + "x " * 60 + "green blue yellow"), (3, "red green")]
    got = {r.doc_id: (sorted(r.near), r.n_near) for r in phrase_index.decontaminate(frame(spark, rows), benchmark_of(spark, items)).collect()}
    assert got == {1: (["1", "3"], 2), 2: ([], 0), 3: ([], 0)}


def bm25_brute(rows, queries, top):
    docs = [(d, Counter(tokens(t))) for d, t in rows]
    size = [sum(c.values()) for _, c in docs]
    mean = sum(size) / len(docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for query, text in queries:
        counts, ranked = Counter(tokens(text)), []
        for (doc, own), n in zip(docs, size):
            score = sum(q * math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * own[w] * (bm25.K1 + 1)
                        / (own[w] + bm25.K1 * (1 - bm25.B + bm25.B * n / mean)) for w, q in counts.items() if own[w])
            if score > 0:
                ranked.append((-round(score, 9), -(1 << 63) if doc is None else doc))
        out += [(query, k + 1, s) for k, (s, _) in enumerate(sorted(ranked)[:top])]
    return out


@pytest.mark.parametrize("shard", [1 << 20, 4000])
def test_search_is_exact(spark, monkeypatch, shard):
    monkeypatch.setattr(bm25, "SHARD_BYTES", shard)
    monkeypatch.setattr(bm25, "BLOCK", 8)
    monkeypatch.setattr(bm25, "QUERY_WORDS", 60)
    rng = random.Random(3)
    rows = corpus(3, 140) + [(None, "no id here w1 w2")]
    queries = [(k, " ".join(words(rng, rng.randint(1, 12), 3000))) for k in range(12)] + [(50, rows[60][1]), (51, None), (51, "w1 w1 w2"), (52, "w1")]
    got = bm25.search(frame(spark, rows), frame(spark, queries), top=7).collect()
    want = sorted((q, k, round(-s, 6)) for q, k, s in bm25_brute(rows, queries, 7))
    assert sorted((r.query_id, r["rank"], round(r.score, 6)) for r in got) == want
    assert bm25.search(frame(spark, []), frame(spark, queries)).collect() == []
    assert bm25.search(frame(spark, rows), frame(spark, [])).collect() == []


def test_pruning_skips_blocks_and_keeps_the_best():
    """Ties at the threshold are opened; blocks below it are not read."""
    import pyarrow as pa

    rng = random.Random(2)
    texts = [" ".join(rng.choice(["common", "usual", "plain"]) for _ in range(20)) for _ in range(4000)]
    for k in (5, 1700, 1701, 3900):
        texts[k] += " rare rare"
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts)], names=["doc_id", "text"])
    (row,) = [r for out in bm25._index(iter([batch])) for r in out.to_pylist()]
    shard = {k: np.frombuffer(row[k], t) for k, t in bm25._ARRAYS.items()}
    chunk = next(bm25.chunks(pa.array(["rare common"])))
    query = np.unique(bm25._words(chunk)[0])
    heavy = bm25._words(next(bm25.chunks(pa.array(["rare"]))))[0][0]
    read = []
    original = bm25._open
    bm25._open = lambda s, opened, low, high: read.append(len(opened)) or original(s, opened, low, high)
    try:
        docs, scores = bm25.search_shard(shard, np.arange(4000), query, np.where(query == heavy, 9.0, 0.1), 20.0, 4)
    finally:
        bm25._open = original
    assert sorted(docs.tolist()) == [5, 1700, 1701, 3900] and sum(read) < 10


def test_blocks_are_opened_in_one_step_for_all_words(monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randint(0, 60)}" for _ in range(rng.randint(0, 12))) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(texts)], names=["d", "t"])
    (row,) = [r for out in bm25._index(iter([batch])) for r in out.to_pylist()]
    shard = bm25.weighed({k: np.frombuffer(row[k], t) for k, t in bm25._ARRAYS.items()}, 6.0)
    high = shard["ends"].astype(np.int64)
    low, opened = np.append(0, high[:-1]), np.array([6, 1, 4])
    steps, ragged = [], bm25.ragged
    monkeypatch.setattr(bm25, "ragged", lambda *given: steps.append(1) or ragged(*given))
    rows, own = bm25._open(shard, opened, low, high)
    want = [(r, w) for w, (a, b) in enumerate(zip(low, high)) for r in range(a, b) if shard["hit_docs"][r] // bm25.BLOCK in (1, 4, 6)]
    assert list(zip(rows.tolist(), own.tolist())) == want and len(steps) <= 2  # once a word before


def test_pipeline_stages(spark, tmp_path):
    """Each stage over small tables beside a plain reading of its rule."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(260):
        text = " ".join(words(rng, rng.randint(30, 90), 4000))
        if i % 6 == 0:
            text = text[:60] + " you pathetic idiot " + text[60:]
        labels.append((i, 0, int(i % 6 == 0)))
        rows.append((i, text, rng.choice(["en", "de"]), f"src{rng.randrange(4)}"))
    rows += [(300 + k, rows[k * 7 + 1][1] + " more", "en", "src1") for k in range(10)] + [(400, None, "en", "src0"), (401, "", None, None)]
    item = rows[8][1].split()[3:16]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    benchmark_of(spark, [(1, " ".join(item))]).write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, kept = kept, stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = {r.doc_id for r in kept.select("doc_id").collect()}
    every = {r[0] for r in rows}
    toxic = {i for i, _, t in labels if t}
    toxic |= {300 + k for k in range(10) if k * 7 + 1 in toxic}
    assert ids["toxicity"] == every - toxic
    assert ids["near copies"] == ids["toxicity"] - set(range(300, 310))
    assert ids["benchmark text"] == ids["near copies"] - {8}
    assert ids["source mix"] <= ids["benchmark text"] - {400, 401} and len(ids["source mix"]) > 100
    final = corpus_pipeline.run(spark, str(tmp_path))
    mixed = sorted((r.doc_id, r.text) for r in kept.collect())
    assert sorted(r.doc_id for r in final.collect()) == [d for d, _ in mixed]
    assert final.agg(F.max(F.col("start") + F.col("n_tokens")), F.sum("n_tokens")).first()[0] == final.agg(F.sum("n_tokens")).first()[0]


def test_pipeline_stages_decide_by_row(spark, tmp_path):
    """Null and repeated ids: clean rows stay, copies and benchmark text go, whatever id they have."""
    rng = random.Random(12)
    texts = [" ".join(words(rng, 60, 4000)) for _ in range(8)]
    near = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[3]), (5, texts[3] + " more"), (None, None), (None, ""),
            (7, texts[4]), (3, texts[4] + " more"), (3, texts[5]), (8, texts[6]), (8, texts[6])]
    kept = corpus_pipeline.drop_near_copies(spark, frame(spark, near), str(tmp_path))
    want = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (5, texts[3] + " more"), (None, None), (None, ""),
            (3, texts[4] + " more"), (3, texts[5]), (8, texts[6])]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)

    benchmark_of(spark, [(1, " ".join(texts[0].split()[4:20]))]).write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, texts[0]), (1, texts[0]), (1, texts[1]), (None, texts[2]), (2, texts[3]), (2, texts[3]), (None, None), (None, "")]
    kept = corpus_pipeline.drop_benchmark_text(spark, frame(spark, rows), str(tmp_path))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(rows[2:])
