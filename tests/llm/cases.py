"""Small tables with the awkward cases every operator must take."""

import random

import pyspark.sql.types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names the operators use inside
    *(T.StructField(n, T.LongType()) for n in ("rid", "node", "sig", "anchor", "k1", "Epoch", "take", "score", "n", "w", "budget", "h", "tie"))])


def frame(spark, rows, parts=3):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, with extra columns."""
    full = []
    for row in rows:
        doc, text, lang, source = (*row, "en", "src1")[:4] if len(row) == 2 else row
        full.append((doc, text, lang, source, None if text is None else len(text), *[7] * 13))
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def words(rng, n, vocabulary=400):
    return [f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n)]


def corpus(seed=1, n=60, passage=60):
    """Texts with exact copies, near copies, shared passages, awkward white space and odd characters."""
    rng = random.Random(seed)
    shared = " ".join(words(rng, passage, 5000))
    out = [None, "", " ", "\n\n", "one", "two words", "É é ß 漢字 😀 emoji", "a" * 450, "ab" * 300, "x y z"]
    while len(out) < n:
        kind, text = rng.random(), " ".join(words(rng, rng.randint(3, 160), 3000))
        if kind < 0.2 and out[-1]:
            out.append(out[-1])
        elif kind < 0.5 and out[-1] and len(out[-1].split()) > 30:
            own = out[-1].split(" ")
            own[rng.randrange(len(own))] = "changed"
            out.append(" ".join(own))
        elif kind < 0.65:
            out.append(f"{text}\n{shared}\t{text[:40]}")
        else:
            out.append(text)
    out.append(" ".join(words(rng, 9000, 6000)))  # very long
    return [(i, t) for i, t in enumerate(out)]
