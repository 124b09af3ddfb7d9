"""Classes of linked nodes from bucket rows, without expanding any bucket into all pairs.

Signature rows are (sig, node, info): nodes that share a signature may be linked. `info` has the
flag LEAD in its lowest bit; only buckets with a LEAD row can hold valid pairs. All links that classes
need are found in steps:

1. A node's weight is the number of bucket rows it meets; in a group of copies of one text the text itself
   meets most. In each round, each bucket's heaviest node that led no round before meets the
   bucket's nodes of other classes; the pairs are verified and nodes close by links get one root.
2. After ROUNDS rounds, buckets whose nodes still have several roots pair the nodes of different roots.
3. Those pairs, too, are verified, and all links give the classes.

A pair under one root is never needed, so nothing is lost, and a bucket of n nodes linked
to one of them costs n pairs. Nodes known to be equal are listed once from the start. Nodes that share a bucket without being
close meet in step 2 by sketches of fixed size alone; pairs, and with them texts, are made of those that pass. Every intermediate is written to the shared folder, so a lost executor costs its tasks alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.workers import settled
from lakekit.operators.components import connected_components
from lakekit.session import discard, freed_shuffles, scratch_path

LEAD = 1
ROUNDS = 3
FEW = 500_000  # nodes that may be broadcast
PARTS, PAIRS = 16, 100_000  # a round's pairs are verified in so many parts at most, of no fewer pairs
SIGNATURE = "sig bigint, node bigint, info bigint"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by signature, LEAD rows first -> the rows of buckets of two rows and more that hold a LEAD row, equal rows as one."""
    last = None  # the bucket at hand: its signature, its first row, and whether that was passed on
    before = None  # the row before
    for batch in batches:
        sig, node, info = (batch.column(i).to_numpy() for i in range(3))
        if not len(sig):
            continue
        again = np.ones(len(sig), bool)
        for at, x in enumerate((sig, node, info)):
            again &= np.concatenate([[before is not None and x[0] == before[at]], x[1:] == x[:-1]])
        before = sig[-1], node[-1], info[-1]
        if again.all():
            continue
        sig, node, info = (x[~again] for x in (sig, node, info))
        new = np.concatenate([[last is None or sig[0] != last[0]], sig[1:] != sig[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
        first_info = np.where(start < 0, last[2] if last else 0, info[start])
        lead = first_info & LEAD == LEAD
        keep = ~new & lead
        keep[:-1] |= new[:-1] & ~new[1:] & lead[:-1]
        rows = [x[keep] for x in (sig, node, info)]
        if not new[0] and last[2] & LEAD and not last[3]:
            rows = [np.append(x, v) for x, v in zip(rows, last[:3])]
        at = start[-1]
        if at < 0:
            last = (last[0], last[1], last[2], True)
        else:
            last = (sig[-1], node[at], info[at], bool(keep[at]))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["sig", "node", "info"])


def stored(rows: DataFrame, name: str, schema: str) -> DataFrame:
    """The rows written and read back; the shuffles that made them are freed."""
    return _at(rows, scratch_path(rows.sparkSession, name), schema)


def _at(rows: DataFrame, path: str, schema: str) -> DataFrame:
    with freed_shuffles(rows.sparkSession):
        rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def _among(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows whose node is one of `nodes`; few nodes are broadcast, so the rows' texts stay where they are."""
    return rows.join(F.broadcast(nodes) if nodes.count() <= FEW else nodes, "node", "left_semi")


def without_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows whose node is not one of `nodes`."""
    nodes = stored(nodes, "left-out", "node bigint")
    return rows.join(F.broadcast(nodes) if nodes.count() <= FEW else nodes, "node", "left_anti")


def _links(pairs: DataFrame, needed: DataFrame, verify: Callable) -> DataFrame:
    """The pairs (u, v) that `verify` keeps, given rows of u, v and their texts.

    A text goes out once per pair, so pairs are verified in parts that send about as many texts as there are; each part's
    shuffle is freed before the next. Few pairs are broadcast to the texts, so a text without a pair in the part stays where it is.
    """
    n = pairs.count()
    parts = max(1, min(-(-2 * n // max(needed.count(), 1)), -(-n // PAIRS), PARTS)) if n > PAIRS else 1
    done = []
    for k in range(parts):
        part = pairs.where(F.pmod(F.xxhash64("u", "v"), F.lit(parts)) == k)
        few = part.count() <= FEW
        part = F.broadcast(part) if few else part
        left = needed.select(F.col("node").alias("u"), F.col("text").alias("a")).join(part, "u")
        right = needed.select(F.col("node").alias("v"), F.col("text").alias("b"))
        if few:
            right = right.join(F.broadcast(part.select("v").distinct()), "v", "left_semi")
        both = left.join(right, "v").select("u", "v", "a", "b")
        done.append(stored(both.mapInArrow(settled(verify), "u bigint, v bigint"), "links", "u bigint, v bigint"))
    return reduce(DataFrame.union, done)


def equal_nodes(keys: DataFrame, by: list[str]) -> DataFrame:
    """(node, rep) for every node that is not the smallest among those with the same key."""
    classes = keys.groupBy(*by).agg(F.min("node").alias("rep"), F.count("*").alias("n")).where("n > 1")
    return stored(keys.join(classes, by).where("node <> rep").select("node", "rep").distinct(), "copies", "node bigint, rep bigint")


def _near_roots(links: DataFrame) -> DataFrame:
    """(node, root): the least node within three links. Equal roots are surely connected, and a
    group around one node has one root; between rounds that is enough to skip pairs."""
    both = links.union(links.select("v", "u")).union(links.select("u", "u")).union(links.select("v", "v")).distinct()
    least = both.groupBy("u").agg(F.min("v").alias("root"))
    for _ in range(2):
        step = least.select(F.col("u").alias("v"), "root")
        least = both.join(step, "v").groupBy("u").agg(F.min("root").alias("root"))
    return stored(least.select(F.col("u").alias("node"), "root"), "near-roots", "node bigint, root bigint")


def linked_classes(copies: DataFrame, signatures: DataFrame, texts: DataFrame, verify: Callable,
                   valid: Callable[[str, str], str], sketch: Callable | None = None, words: int = 0,
                   close: Callable[[str, str], str] | None = None, rounds: int = ROUNDS, once: bool = True) -> DataFrame:
    """(node, root) of every node with a link or an equal: the smallest node reachable over those.

    texts(node, text) has each node's text, valid(x, y) is a SQL condition on two info columns that
    every link meets in some bucket, and verify maps Arrow batches (u, v, a, b) to kept (u, v). `sketch` maps
    batches (node, text) to (node, s0 .. s`words`-1), and close(u, v) is a SQL condition on rows u and v with those
    and info that every link meets: it spares pairs that only share a bucket. Signatures leave equal nodes out, or give them as equal
    rows. A node whose text may come several times is told by `once`.
    """
    spark = signatures.sparkSession
    ordered = signatures.repartition("sig").sortWithinPartitions("sig", F.expr(f"{LEAD} - (info & {LEAD})"), "node")
    bucket_path, row_path = scratch_path(spark, "buckets"), scratch_path(spark, "rows")
    buckets = _at(ordered.mapInArrow(settled(_shared), SIGNATURE), bucket_path, SIGNATURE)
    # dealt by signature once: what follows up to the join needs no other shuffle
    rows = buckets.repartition("sig").distinct()
    sizes = rows.groupBy("sig").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    rows = _at(rows.join(sizes.select("sig", "n"), "sig"), row_path, f"{SIGNATURE}, n bigint")
    discard(spark, bucket_path)
    weights = rows.groupBy("node").agg(F.sum("n").alias("weight"))
    members = stored(rows.join(weights, "node").select("sig", "node", "info", "weight"), "members", f"{SIGNATURE}, weight bigint")
    discard(spark, row_path)
    needed = _among(texts, members.select("node").distinct()).select("node", "text")
    needed = stored(needed if once else needed.groupBy("node").agg(F.min("text").alias("text")), "member-texts", "node bigint, text string")

    pair, same = "u bigint, v bigint", copies.select(F.col("rep").alias("u"), F.col("node").alias("v"))
    seen, links, led = spark.createDataFrame([], pair), spark.createDataFrame([], pair), spark.createDataFrame([], "node bigint")
    open_ = members.withColumn("root", F.col("node"))
    for turn in range(rounds + 1):
        if turn < rounds:
            heads = open_.where(f"(info & {LEAD}) <> 0").join(led, "node", "left_anti").groupBy("sig").agg(
                F.max(F.struct("weight", "node", "info", "root")).alias("head"))
            met = open_.join(heads, "sig").where(f"root <> head.root and ({valid('info', 'head.info')})").select(
                F.col("head.node").alias("head"), "node")
            led = stored(led.union(met.select("head")).distinct(), "heads", "node bigint")
            found = met.select(F.least("head", "node").alias("u"), F.greatest("head", "node").alias("v"))
        else:
            rows, names, test = open_, [], f"u.node < v.node and u.root <> v.root and ({valid('u.info', 'v.info')})"
            if sketch is not None:
                names = [f"s{k}" for k in range(words)]
                schema = ", ".join(["node bigint", *(f"{n} bigint" for n in names)])
                rows = rows.join(stored(needed.mapInArrow(settled(sketch), schema), "sketches", schema), "node")
                test += f" and ({close('u', 'v')})"
            rows = rows.select("sig", "node", "info", "root", *names)
            found = rows.alias("u").join(rows.alias("v"), F.expr(f"u.sig = v.sig and {test}")).selectExpr("u.node AS u", "v.node AS v")
        pairs = stored(found.distinct().join(seen, ["u", "v"], "left_anti"), "pairs", pair)
        if not pairs.isEmpty():
            seen, links = seen.union(pairs), links.union(_links(pairs, needed, verify))
        if turn < rounds:
            labelled = members.join(_near_roots(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
            split = labelled.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("sig")
            open_ = stored(labelled.join(split, "sig").select("sig", "node", "info", "weight", "root"), "open", f"{SIGNATURE}, weight bigint, root bigint")
            if open_.isEmpty():
                break
    every = stored(links.union(same), "all-links", pair)
    return connected_components(every.select(F.col("u").alias("node")).union(every.select("v")).distinct(), every)
