"""Page text, secrets, toxicity, token files and the mix against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import corpus, frame
from pyspark.sql import functions as F

from lakekit.llm import arrays, mixing, page_diff, queries, secret_scan, token_files, toxicity, workers

SF_DIR = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


PAGES = [
    (1, "https://a.com/x/1", page("<div>Site top</div><p>One &amp; only\n  story</p><p>More<br>of it</p><div>Site end</div>")),
    (2, "https://a.com/x/2", page("<div>Site top</div><p>Another story</p><div>Site end</div>")),
    (3, "https://a.com/y", page("<div>Other</div><p>Alone</p>")),
    (4, "http://b.org/", page("<nav><ul><li>Menu</li></ul></nav><div class='ad'>Buy</div><article><h1>Head&shy;</h1><p><b>Bold<br><p>te<i>xt</i>"
                              "<aside>side</aside><form>f<input></form><div class=\"comments\"><p>me too</p></div></article><footer>&copy; b</footer>")),
    (5, "http://b.org/copy", page("<nav>open menu<article><h1>Head&shy;</h1><p><b>Bold<br><p>text</article><footer>&copy; b</footer>")),
    (6, "", None), (None, None, ""), (7, "http://c.net/1", "just < text &#65; <!-- gone -->here"), (7, "http://c.net/1", "just < text &#65; <!-- gone -->here"),
]
PAGE_TEXT = {1: "One & only story More of it", 2: "Another story", 3: "Other Alone", 4: "Head­ Bold text", 5: "Head­ Bold text", 6: "", None: "",
             7: "just < text A here"}


def pages_frame(spark, rows, parts=2):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id bigint, url string, html string, bucket int, host int").repartition(parts)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_main_text(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = page_diff.main_text(pages_frame(spark, PAGES)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == len(PAGES)
    assert {r.page_id: r.text for r in got} == PAGE_TEXT
    assert page_diff.main_text(pages_frame(spark, [])).collect() == []


def test_shared_lines_are_a_longest_common_subsequence(monkeypatch):
    rng = random.Random(2)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old, row = row, [0]
            for j, y in enumerate(b):
                row.append(old[j] + 1 if x == y else max(old[j + 1], row[-1]))
        return row[-1]

    for bits in (1 << 28, 40):  # the second forces the halving
        monkeypatch.setattr(page_diff, "ROW_BITS", bits)
        for _ in range(200):
            a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 25))] for _ in range(2))
            got = sorted(page_diff.shared_lines(a, b))
            assert len(got) == longest(a, b)
            it = iter(b)
            assert all(a[i] in it for i in got)


SECRETS = ['password = "abc123"', "token=tok:abcdef", "secret=token:abcdef", "ſecret=abcdefg x", "API_KEY: 'xK9#longer'", "AKIA" + "A1" * 10,
           "AKIAAKIA" + "Z" * 12, "AKIASHORT", "0123456789abcdef01234567", "0123456789ABCDEF01234567", "é" * 3 + "passwd:qwertyuiop", "password is Zx8!kfQ2pwm",
           "password is password", "x" * 30_000 + " secret = " + "f" * 5000, None, "", "pin to 7"]


def secrets_brute(text):
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secret_scan(spark):
    rows = list(enumerate(SECRETS)) + [(None, "token = abcdef")]
    got = secret_scan.digest(secret_scan.scan(frame(spark, rows))).collect()
    want = {i: secrets_brute(t or "") for i, t in rows}
    assert {r.doc_id: r.base_sha256 for r in got} == {i: hashlib.sha256(x.encode()).hexdigest() for i, x in want.items()}
    by_id = {r.doc_id: r for r in got}
    assert by_id[11].spans == "guess:0:23" and by_id[11].n_guess == 1  # strong value in a loose context
    assert by_id[12].spans == "" and by_id[14].n_assign == 0
    for r in got:  # base spans stay among all spans
        assert set(filter(None, want[r.doc_id].split(","))) <= set(r.spans.split(","))
    assert secret_scan.scan(frame(spark, [])).collect() == []


def test_long_values_are_cut_whole(monkeypatch):
    ranks = {w: k for k, w in enumerate(["love", "monkey", "the", "cat", "counterrevolutionaries"], 1)}
    rng = random.Random(4)
    fillers = ["-" * 70, "ab" * 40, "=" * 65, "abc123" * 12, "qwqw" * 20, "counterrevolutionaries" * 3]
    ends = ["", "x", "monkey", "1999-12-31", "xK9#", "abcdefghij"]
    values = [a + f + b for f in fillers for a in ends for b in ends] + ["".join(rng.choice("lovecat19qw-") for _ in range(n)) for n in (65, 70, 90)]
    values = [v for v in values if len(v) > 64]
    got = [secret_scan.guess_cost(v, ranks) for v in values]
    monkeypatch.setattr(secret_scan, "VALUE_MAX", 1000)
    want = [secret_scan.guess_cost(v, ranks) for v in values]
    assert [g < secret_scan.MIN_GUESSES for g in got] == [w < secret_scan.MIN_GUESSES for w in want]
    assert any(w < secret_scan.MIN_GUESSES for w in want) and any(w >= secret_scan.MIN_GUESSES for w in want)
    for v, g, w in zip(values, got, want):
        assert w >= secret_scan.MIN_GUESSES or g == pytest.approx(w, rel=1e-9), v
    monkeypatch.undo()
    for n in (60, 70, 5000):
        assert secret_scan.spans_of("pwd: " + "-" * n + "x", ranks) == []


def test_guess_cost_is_the_cheapest_cut():
    ranks = {w: k for k, w in enumerate(["love", "monkey", "the", "cat"], 1)}
    rng = random.Random(1)

    def brute(value):
        parts = {}
        for i, j, cost in secret_scan.pieces(value, ranks):
            parts[i, j] = min(parts.get((i, j), np.inf), max(1.0, cost))
        size, best = max(10, secret_scan._alphabet(value)), np.inf
        for cuts in range(1 << (len(value) - 1)):
            ends = [k for k in range(1, len(value)) if cuts >> (k - 1) & 1] + [len(value)]
            if len(ends) > 12:
                continue
            product, begin = 1.0, 0
            for end in ends:
                product, begin = product * min(parts.get((begin, end), np.inf), float(size) ** (end - begin)), end
            best = min(best, float(np.prod(range(1, len(ends) + 1))) * product + 1e4 ** (len(ends) - 1))
        return best

    for value in ["lovecat", "qwerty12", "aaaa1999", "xK9#p", "Th3c4t", "abcabcabc"] + ["".join(rng.choice("lovecat19qw") for _ in range(9)) for _ in range(12)]:
        assert secret_scan.guess_cost(value, ranks) == pytest.approx(brute(value), rel=1e-9), value
    assert secret_scan.guess_cost("", ranks) == 1.0
    assert secret_scan.guess_cost("ab" * 500, ranks) < 1e8 < secret_scan.guess_cost("xK9#pQ2!vB7$", ranks)
    for weak, strong in (("love", "lovx"), ("qwertyui", "qmzpwoxn"), ("20011231", "29817734"), ("aaaaaaaa", "aqzmaplw")):
        assert secret_scan.guess_cost(weak, ranks) < secret_scan.guess_cost(strong, ranks)


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(500):
        toxic, own = i % 5 == 0, [rng.choice("alpha beta gamma delta rosé house tree".split()) for _ in range(rng.randint(5, 80))]
        if toxic:
            own.insert(rng.randrange(len(own)), rng.choice(["idiot", "MORON", "clown-face"]))
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    docs = frame(spark, rows + [(9001, None), (9002, ""), (9003, "x"), (9004, "tree " * 40_000), (None, "idiot")])
    marks = spark.createDataFrame([*labels, (9001, 1), (7, None), (None, 1)], "doc_id bigint, toxic int").withColumn("text", F.lit(0))
    model = toxicity.train_on_labels(docs, marks)
    got = toxicity.score(docs.drop("score"), model, ["doc_id"]).collect()
    assert len(got) == 505
    score = {r.doc_id: r.score for r in got}
    assert all(0 <= s <= 1 for s in score.values())
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sorted(held) == sorted(r.doc_id for r in docs.where(toxicity.held_out()).select("doc_id").collect() if r.doc_id < 500)
    assert all((score[i] >= 0.7) == (i % 5 == 0) for i in held)
    assert score[9001] == score[9002] and score[9004] < 0.7
    assert toxicity.score(docs.limit(0).drop("score"), model, ["doc_id"]).collect() == []
    blank = toxicity.train_on_labels(docs, marks.limit(0))
    assert {round(r.score, 9) for r in toxicity.score(docs, blank, ["doc_id"], name="s").select(F.col("s").alias("score")).collect()} == {0.0}


def test_scores_count_each_ngram_once():
    import pyarrow as pa

    from lakekit.llm.arrays import chunks

    texts = ["Hello  hello, WÖRLD!", "", "ab", "hello hello"]
    chunk = next(chunks(pa.array(texts)))
    grams, rows = toxicity._present(*toxicity._grams(chunk))
    for k, text in enumerate(texts):
        plain = re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        want = {plain[i:i + n] for n in toxicity.SIZES for i in range(len(plain) - n + 1)}
        assert (rows == k).sum() == len(want)


def tokens_brute(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_token_files(spark, monkeypatch):
    odd = [None, "", " ", "Don't stop<|endoftext|>now ß́ éﬁ \x1c a b   tab\tnew\r\nline", "ΑΣ Σ", "It's, OK. A.B. x!, it's. 'S, <|ENDOFTEXT|>, 3.14, a., ., ,. Ab, AB. ab", "  lead", "漢字 かな 😀", "x" * 3000]
    rows = [(i * 3 % 101, t) for i, t in enumerate([*odd, *(t for _, t in corpus(4, 40))])]
    docs = frame(spark, rows)
    path = token_files.write_tokens(docs, TOKENIZER)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    rows.sort()
    start = 0
    for (doc, _), ids, r in zip(rows, tokens_brute([t for _, t in rows]), got, strict=True):
        data = np.array(ids, "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (doc, start, len(ids), zlib.crc32(data), data)
        start += len(ids)
    same = frame(spark, [(5, "b"), (5, "a"), (5, "a"), (None, "c")])
    got = token_files.read_tokens(spark, token_files.write_tokens(same, TOKENIZER)).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 2), (5, 2, 2), (5, 4, 2), (5, 6, 2)]
    assert token_files.read_tokens(spark, token_files.write_tokens(frame(spark, []), TOKENIZER)).collect() == []


def test_words_pass_the_normalizer_by(monkeypatch):
    rng, letters = random.Random(9), "abzABZßÀÿÖéñ×÷µªŸİ́'1,.#"
    texts = [None, *(" ".join("".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(40)) for _ in range(300))]
    texts += ["\n" + "".join(map(chr, range(33, 0x250))), " ".join(map(chr, range(33, 0x250))), " ".join(chr(c) + "a," for c in range(33, 0x250))]
    encoder, taken = token_files.PieceEncoder(TOKENIZER), []
    whole = encoder.tokenizer
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda pieces, words: taken.append((words, len(pieces))) or encode(pieces, words))
    for _ in range(2):
        ids, sizes = encoder.encode(pa.array(texts))
        want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert sorted(w for w, _ in taken) == [False, True]  # once each: the second time all pieces are known


def test_huffman_lengths_are_best_within_the_limit():
    rng = np.random.default_rng(2)
    for n, limit in ((1, 4), (2, 4), (5, 3), (8, 3), (9, 4), (200, 8), (300, 12)):
        counts = np.sort((rng.pareto(0.4, n) * 10 + 1).astype(np.int64).clip(1, 10 ** 9))[::-1]
        bits = token_files.code_lengths(counts, limit)
        assert bits.max() <= limit and (0.5 ** bits).sum() <= 1
        if n > 1:
            assert (0.5 ** bits).sum() == 1
        if n <= 9 and n > 1:  # all length sets that fill the code space
            def fill(left, room, top):
                if left == 0:
                    return [[]] if room == 0 else []
                return [[b, *rest] for b in range(1, top + 1) if room >= 2 ** (limit - b) for rest in fill(left - 1, room - 2 ** (limit - b), b)]
            least = min(sum(b * c for b, c in zip(sorted(own), sorted(counts, reverse=True))) for own in fill(n, 2 ** limit, limit))
            assert int((bits * counts).sum()) == least
        ids = np.arange(n) * 7
        order, codes = token_files.canonical_codes(ids, bits)
        text = sorted(format(c, f"0{b}b") for c, b in zip(codes.tolist(), bits[order].tolist()))
        assert all(not y.startswith(x) for x, y in zip(text, text[1:]))  # no code begins another
        drawn = rng.choice(ids, 5000)
        code_of, bits_of = np.zeros(ids.max() + 1, np.uint64), np.zeros(ids.max() + 1, np.int64)
        code_of[ids[order]], bits_of[ids] = codes.astype(np.uint64), bits
        code, marks = token_files._pack(drawn, code_of, bits_of)
        assert (token_files.decoder(ids, bits)(code, marks, len(drawn)) == drawn).all()


@pytest.mark.parametrize("share,epochs", [((3, 5), 3), ((1, 1), 2), ((7, 3), 3), ((0, 1), 1)])
def test_mix_meets_its_sql(spark, share, epochs):
    rng = random.Random(7)
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["src0", "src0", "src0", "src4", "", None, f"s{rng.randrange(9)}"])) for i, t in corpus(6, 90)]
    rows += [(5, "same same same", "en", "src0")] * 2 + [(None, "no id", "en", "src4")]
    docs = frame(spark, rows)
    mixed = mixing.mix_documents(docs, share, epochs)
    got = [tuple(r) for r in mixed.select("doc_id", *mixing.LEVELS, "epoch", "take").collect()]
    duck = duckdb.connect()
    documents = docs.select("doc_id", "text", "lang", "source").toArrow()
    duck.register("documents", documents)
    want = duck.execute(mixing.oracle_sql(share, epochs)).fetchall()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, want))
    tokens = sum(len(re.findall("[^\x20\x09-\x0d]+", t or "")) for _, t, *_ in rows)
    assert sum(r[-1] for r in got) == min(tokens * share[0] // share[1], tokens * epochs)
    cut = mixed.select(mixing.cut_text(F.col("text"), F.col("take"), F.col("_mix_n")).alias("t"), "take", "text").collect()
    for r in cut:
        assert len(re.findall("[^\x20\x09-\x0d]+", r.t)) == r.take and r.text.startswith(r.t)


def test_shortage_stays_among_siblings(spark):
    """A source that runs dry is made up for by its own language before another one gains."""
    rows = [(i, "t " * 10, "en", "src0") for i in range(2)] + [(10 + i, "t " * 10, "en", "src3") for i in range(40)] + [
        (100 + i, "t " * 10, "de", "src6") for i in range(40)]
    levels = [F.lit("d"), F.col("lang"), F.col("source")]
    weights = [F.lit(1), F.lit(1), F.lit(1)]
    mixed = mixing.mix(frame(spark, rows), levels, weights, (1, 2), 1)
    got = {(r[0], r[1]): r[2] for r in mixed.groupBy(mixing.LEVELS[1], mixing.LEVELS[2]).agg(F.sum("take")).collect()}
    assert got == {("en", "src0"): 20, ("en", "src3"): 185, ("de", "src6"): 205}
    none = mixing.mix(frame(spark, rows), levels, [F.lit(1), F.when(F.col(mixing.LEVELS[1]) == "de", 0).otherwise(1), F.lit(1)], (1, 2), 1)
    assert {r[0] for r in none.select(mixing.LEVELS[1]).distinct().collect()} == {"en"}
    assert mixing.mix_documents(frame(spark, [])).collect() == []


def test_the_mix_does_not_hold_the_tree_in_its_plan(spark):
    """The budgets of the tree are written before the documents are chosen: one plan of all levels, used five times, filled the driver."""
    plan = mixing.mix_documents(frame(spark, corpus(3)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 2 and plan.count("Aggregate") == 0


def test_queries_with_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    for key, sql in queries.oracle_sql().items():
        df = queries.queries()[key](spark, SF_DIR)
        cursor = duck.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(map(str, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(str, cursor.fetchall()))


def test_workers_keep_only_the_tables_in_use():
    made = workers.table(lambda size: np.zeros(size))
    try:
        def uses(batches):
            for batch in batches:
                arrays.powers(10)
                yield made(5)

        assert len(list(workers.settled(uses, made)(iter([1, 2])))) == 2
        assert made.cache_info().currsize == 1 and arrays._powers_of.cache_info().currsize == 0
        assert list(workers.settled(lambda batches: batches)(iter([]))) == [] and made.cache_info().currsize == 0
    finally:
        workers._TABLES.remove(made)
