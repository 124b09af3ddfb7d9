"""Mixing sources to target weights in a tree of domains, languages and sources.

The budget in tokens goes down the tree by weight. A node can take at most EPOCHS times
its tokens; what a child cannot take goes to its siblings by their weights, and leaves their parent
only when all children are full: each node receives no more than its subtree holds, so
a shortage inside it is settled among siblings before it reaches an ancestor. Weights and
tokens are integers and shares are rounded by running totals, so the budget is met to the token.

Every leaf then reads its documents in epochs. Whole epochs take all its documents; the last
epoch takes a prefix of the leaf's token stream, whose documents stand in the order of the
hash of (seed, epoch, id), and cuts the document at its end. Only the documents of one
of 4,096 hash buckets per leaf are ever sorted: buckets before it are taken whole.

Tokens are words (runs of other characters than white space). Null labels form a node of
their own, named by the empty text. Null, empty and blank texts have no tokens and are not chosen.
Documents without an id are ordered by the empty text as id. Repeated rows are each a
document of their own; rows equal in id and text stand in any order, which cannot be told
apart. An empty table gives an empty mix. Other columns are carried along unless named `epoch` or `take`,
which the result replaces; names beginning with `_mix_` are reserved.

The tree is one row per source. It is broadcast to the documents while it has at most TREE_ROWS
rows and joined by shuffle beyond that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakekit.session import cut_lineage

EPOCHS = 3
SHARE = (3, 5)
SEED = 17
TREE_ROWS = 20_000
TOKEN = r"[^\x20\x09-\x0D]+"
BIG = "decimal(38,0)"
LEVELS = ("_mix_1", "_mix_2", "_mix_3")


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def _fill(children: DataFrame, above: list[str], key: str) -> DataFrame:
    """`budget` of each child, from `_mix_given` of its parent, weights `w` and room `cap`.

    The children with the least room per weight fill up first; a child is full when its room is at most its
    share of what the fuller ones left. The others share the rest by running totals in
    the order of their names.
    """
    w, cap = F.col("w").cast(BIG), F.col("cap").cast(BIG)
    unit = F.greatest(F.col("w"), F.lit(1))
    room = W.partitionBy(*above).orderBy(F.expr("cap div greatest(w, 1)"), ((F.col("cap") % unit) * 1_000_000_000 / unit).cast("bigint"), key)
    earlier, later = room.rowsBetween(W.unboundedPreceding, -1), room.rowsBetween(0, W.unboundedFollowing)
    left = F.col("_mix_given").cast(BIG) - F.coalesce(F.sum(cap).over(earlier), F.lit(0).cast(BIG))
    named = W.partitionBy(*above).orderBy(key)
    upto, before = named.rowsBetween(W.unboundedPreceding, 0), named.rowsBetween(W.unboundedPreceding, -1)
    sums = children.withColumn("_mix_left", left).withColumn("_mix_later", F.sum(w).over(later)).withColumn(
        "_mix_full", (cap * F.col("_mix_later") <= w * F.col("_mix_left")))
    open_w = F.when(F.col("_mix_full"), 0).otherwise(F.col("w")).cast(BIG)
    full_cap = F.when(F.col("_mix_full"), F.col("cap")).otherwise(0).cast(BIG)
    every = W.partitionBy(*above)
    sums = sums.withColumn("_mix_rest", F.col("_mix_given") - F.sum(full_cap).over(every).cast("bigint")).withColumn(
        "_mix_open", F.sum(open_w).over(every).cast("bigint")).withColumn(
        "_mix_to", F.sum(open_w).over(upto).cast("bigint")).withColumn(
        "_mix_from", F.coalesce(F.sum(open_w).over(before).cast("bigint"), F.lit(0)))
    cut = "(cast(_mix_rest as decimal(38,0)) * {} ) div greatest(_mix_open, 1)"
    share = F.expr(cut.format("_mix_to")) - F.expr(cut.format("_mix_from"))
    return sums.withColumn("budget", F.when(F.col("_mix_full"), F.col("cap")).otherwise(share)).select(
        *above, key, "budget")


def budgets(leaves: DataFrame, weights: list[Column], budget: int) -> DataFrame:
    """(levels, budget) for leaves(levels, cap); weights[i] is an integer expression over the label of level i."""
    # a leaf under a node of no weight has no room, so no parent's budget counts on it
    weighed = F.when(reduce(lambda a, b: a & b, (w > 0 for w in weights)), F.col("cap")).otherwise(0)
    leaves = leaves.withColumn("cap", weighed)
    given = leaves.agg(F.least(F.lit(budget), F.coalesce(F.sum("cap"), F.lit(0)).cast("bigint")).alias("_mix_given")).withColumn(
        "_mix_0", F.lit(0))
    above, rooted = ["_mix_0"], leaves.withColumn("_mix_0", F.lit(0))
    for level, weight in zip(LEVELS, weights):
        nodes = rooted.groupBy(*above, level).agg(F.sum("cap").cast("bigint").alias("cap")).withColumn("w", weight.cast("bigint"))
        given = _fill(nodes.join(given, above), above, level).withColumnRenamed("budget", "_mix_given")
        above = [*above, level]
    return given.select(*LEVELS, F.col("_mix_given").alias("budget"))


def mix(docs: DataFrame, levels: list[Column], weights: list[Column], share: tuple[int, int] = SHARE, epochs: int = EPOCHS,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The chosen rows of `docs` with `epoch` (1 and up) and `take`, the tokens taken from the document's start.

    The budget is share[0] / share[1] of all tokens, rounded down. weights[i] reads the
    column LEVELS[i].
    """
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c.lower() not in ("epoch", "take")]
    labelled = docs.select(*kept, *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(LEVELS, levels)),
                           token_count(F.col(text_col)).alias("_mix_n")).where("_mix_n > 0")
    # the tree's tables are small but many operators stand on them: each is written once, so no later plan holds or runs them again
    supply = cut_lineage(labelled.groupBy(*LEVELS).agg(F.sum("_mix_n").alias("supply")))
    leaves = supply.withColumn("cap", F.col("supply") * epochs)
    total = leaves.agg(F.sum("supply"), F.count("*")).first()
    tokens, n_leaves = total[0] or 0, total[1]
    plan = cut_lineage(leaves.join(budgets(leaves, weights, tokens * share[0] // share[1]), list(LEVELS)).select(
        *LEVELS, F.expr("budget div supply").alias("_mix_whole"), (F.col("budget") % F.col("supply")).alias("_mix_part")))

    def order() -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("_mix_whole") + 1).cast("string"),
                                 F.coalesce(F.col(id_col).cast("string"), F.lit(""))))

    def placed(rows: DataFrame, tree: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(tree) if n_leaves <= TREE_ROWS else tree, list(LEVELS))

    slim = placed(labelled.select(id_col, *LEVELS, "_mix_n"), plan.where("_mix_part > 0"))
    buckets = slim.groupBy(*LEVELS, F.substring(order(), 1, 3).alias("_mix_cut")).agg(F.sum("_mix_n").alias("n"))
    ahead = W.partitionBy(*LEVELS).orderBy("_mix_cut").rowsBetween(W.unboundedPreceding, -1)  # at most 4,096 rows
    cuts = buckets.withColumn("_mix_base", F.coalesce(F.sum("n").over(ahead), F.lit(0))).join(plan, list(LEVELS)).where(
        "_mix_base < _mix_part and _mix_part <= _mix_base + n").select(*LEVELS, "_mix_cut", "_mix_base")
    tree = cut_lineage(plan.join(cuts, list(LEVELS), "left"))

    rows = placed(labelled, tree).withColumn("_mix_at", order())
    bucket = F.substring("_mix_at", 1, 3)
    chosen = rows.withColumn("_mix_epochs", F.col("_mix_whole") + F.when(bucket < F.col("_mix_cut"), 1).otherwise(0))
    whole = chosen.where("_mix_epochs > 0").withColumn("epoch", F.explode(F.expr("sequence(1L, _mix_epochs)"))).withColumn(
        "take", F.col("_mix_n"))
    inside = W.partitionBy(*LEVELS).orderBy("_mix_at", F.col(id_col), F.col(text_col))
    cut = rows.where(bucket == F.col("_mix_cut")).withColumn("_mix_seen", F.col("_mix_base") + F.coalesce(
        F.sum("_mix_n").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    last = cut.where("_mix_seen < _mix_part").withColumn("epoch", F.col("_mix_whole") + 1).withColumn(
        "take", F.least(F.col("_mix_n"), F.col("_mix_part") - F.col("_mix_seen")))
    columns = [*kept, *LEVELS, "_mix_n", "epoch", "take"]
    return whole.select(*columns).unionByName(last.select(*columns))


def cut_text(text: Column, take: Column, whole: Column) -> Column:
    """The text up to its `take`-th token."""
    parts = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{TOKEN}"), F.lit(0))
    return F.when(take >= whole, text).otherwise(F.array_join(F.slice(parts, F.lit(1), take.cast("int")), ""))


# The production tree: a source's domain is the code of its name's last character modulo 3.
DOMAIN = "'d' || cast(ascii(right(coalesce(source, ''), 1)) % 3 as {text})"
DOMAIN_WEIGHT = "case {label} when 'd0' then 5 when 'd1' then 3 else 2 end"
LANG_WEIGHT = "case {label} when 'en' then 6 else 2 end"
SOURCE_WEIGHT = "1 + ascii(right({label}, 1)) % 4"


def mix_documents(docs: DataFrame, share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """`mix` over documents with the production tree and weights."""
    weights = [F.expr(w.format(label=n)) for w, n in zip((DOMAIN_WEIGHT, LANG_WEIGHT, SOURCE_WEIGHT), LEVELS)]
    return mix(docs, [F.expr(DOMAIN.format(text="string")), F.col("lang"), F.col("source")], weights, share, epochs, seed)


def _fill_sql(name: str, nodes: str, above: str, key: str) -> str:
    """The same filling of one level, as common table expressions."""
    return f"""
{name}_a as (select *, given - coalesce(sum(cap) over (r rows between unbounded preceding and 1 preceding), 0) as l,
    sum(w) over (r rows between current row and unbounded following) as lw from {nodes}
    window r as (partition by {above} order by cap // greatest(w, 1), (cap % greatest(w, 1)) * 1000000000 // greatest(w, 1), {key})),
{name}_b as (select *, cap::hugeint * lw <= w::hugeint * l as is_full from {name}_a),
{name}_c as (select *, given - sum(case when is_full then cap else 0 end) over (partition by {above}) as rest,
    sum(case when is_full then 0 else w end) over (partition by {above}) as ow,
    sum(case when is_full then 0 else w end) over (partition by {above} order by {key} rows unbounded preceding) as hi,
    case when is_full then 0 else w end as own from {name}_b),
{name} as (select * exclude (given), case when is_full then cap else
    rest::hugeint * hi // greatest(ow, 1) - rest::hugeint * (hi - own) // greatest(ow, 1) end as budget from {name}_c)"""


def oracle_sql(share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for the mix of `documents`: doc_id, domain, lang, source, epoch, take."""
    return f"""
with base as (select doc_id, text, {DOMAIN.format(text='varchar')} as k1, coalesce(lang, '') as k2, coalesce(source, '') as k3,
    len(regexp_extract_all(text, '{TOKEN}')) as n from documents where text is not null),
docs0 as (select * from base where n > 0),
leaf as (select k1, k2, k3, sum(n) as supply, sum(n) * {epochs} as cap from docs0 group by all),
goal as (select least(sum(supply) * {share[0]} // {share[1]}, sum(cap)) as b from leaf),
n1 as (select 0 as k0, k1, sum(cap) as cap, {DOMAIN_WEIGHT.format(label='k1')} as w, any_value(b) as given from leaf, goal group by k1),
{_fill_sql('f1', 'n1', 'k0', 'k1')},
n2 as (select l.k1, l.k2, sum(l.cap) as cap, {LANG_WEIGHT.format(label='l.k2')} as w, any_value(f1.budget) as given
    from leaf l join f1 on l.k1 = f1.k1 group by l.k1, l.k2),
{_fill_sql('f2', 'n2', 'k1', 'k2')},
n3 as (select l.k1, l.k2, l.k3, l.cap, l.supply, {SOURCE_WEIGHT.format(label='l.k3')} as w, f2.budget as given
    from leaf l join f2 on l.k1 = f2.k1 and l.k2 = f2.k2),
{_fill_sql('f3', 'n3', 'k1, k2', 'k3')},
d as (select docs0.*, budget // supply as whole, budget % supply as part,
    md5('{seed}:' || (budget // supply + 1)::bigint::varchar || ':' || coalesce(doc_id::varchar, '')) as h
    from docs0 join f3 using (k1, k2, k3)),
e as (select *, coalesce(sum(n) over (partition by k1, k2, k3 order by h, doc_id, text rows between unbounded preceding and 1 preceding), 0) as seen from d),
chosen as (select e.*, u.epoch, n as take from e, unnest(range(1, whole::bigint + 1)) as u(epoch)
    union all select e.*, (whole + 1)::bigint, least(n, part - seen) from e where seen < part)
select doc_id, k1 as domain, k2 as lang, k3 as source, epoch::bigint as epoch, take::bigint as take from chosen"""
