"""Clustering: neighbours, DBSCAN, KMeans and silhouette scores."""

from pyspark.sql import functions as F

from lakekit.operators import dbscan as db
from lakekit.operators import features, kmeans, metric, neighbours, silhouette, silhouette_bounds
from lakekit.plans.registry import query, table
from lakekit.session import cut_lineage, scratch_path

EPS, MIN_POINTS = 0.02, 6
CENTRES = [(-0.1, -0.1), (-0.1, 0.1), (0.1, -0.1), (0.1, 0.1)]

PLANE = "(SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b FROM embeddings)"
CLOSE = f"(x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) <= CAST({EPS} AS DOUBLE) * CAST({EPS} AS DOUBLE)"


def _plane(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"))


def _labelled(spark, sf_dir):
    return kmeans.assign(_plane(spark, sf_dir).select("a", "b").distinct(), ["a", "b"], CENTRES)


ASSIGNED = f"""(SELECT vec_id, a, b, (SELECT arg_min(i, d) FROM (SELECT i, (a - ca) * (a - ca) + (b - cb) * (b - cb) AS d
  FROM (VALUES {','.join(f'({i}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))' for i, (x, y) in enumerate(CENTRES))}) AS c(i, ca, cb))) AS label
  FROM {PLANE})"""


@query("eps_neighbours", f"""
WITH p AS (SELECT DISTINCT a, b FROM {PLANE})
SELECT x.a, x.b, count(*) AS n_neighbours FROM p x JOIN p y ON {CLOSE} GROUP BY x.a, x.b
""")
def eps_neighbours(spark, sf_dir):
    points = features.distinct_features(_plane(spark, sf_dir), ["a", "b"])
    return neighbours.eps_neighbours(points, ["a", "b"], EPS)


# Clustering as SQL: distinct points, pairs within the radius, core points, their components, borders and noise.
DBSCAN = """
WITH RECURSIVE p AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {cols}) AS id, {cols} FROM (SELECT DISTINCT {cols} FROM {rows})),
 e AS MATERIALIZED (SELECT x.id AS i, y.id AS j FROM p x JOIN p y ON {close}),
 core AS MATERIALIZED (SELECT i FROM e GROUP BY i HAVING count(*) >= {min_points}),
 ce AS MATERIALIZED (SELECT e.i, e.j FROM e JOIN core c ON c.i = e.i JOIN core d ON d.i = e.j),
 r(i, j) AS (SELECT i, j FROM ce UNION SELECT r.i, ce.j FROM r JOIN ce ON r.j = ce.i),
 comp AS (SELECT i, min(j) AS root FROM r GROUP BY i),
 bord AS (SELECT e.i, min(comp.root) AS root FROM e JOIN comp ON comp.i = e.j
          WHERE e.i NOT IN (SELECT i FROM core) GROUP BY e.i),
 clustered AS (SELECT * FROM comp UNION ALL SELECT * FROM bord),
 numbered AS (SELECT i, dense_rank() OVER (ORDER BY root) - 1 AS label FROM clustered),
 noise AS (SELECT id AS i, (SELECT count(*) FROM p) + row_number() OVER (ORDER BY id) AS label
           FROM p WHERE id NOT IN (SELECT i FROM clustered)),
 labels AS (SELECT * FROM numbered UNION ALL SELECT * FROM noise)
SELECT s.vec_id, {cols}, labels.label FROM {rows} s JOIN p USING ({cols}) JOIN labels ON labels.i = p.id
"""


def _dbscan_sql(rows, columns, eps, min_points):
    close = " + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in columns) + f" <= CAST({eps} AS DOUBLE) * CAST({eps} AS DOUBLE)"
    return DBSCAN.format(rows=rows, cols=", ".join(columns), close=close, min_points=min_points)


@query("dbscan", f"SELECT vec_id, label FROM ({_dbscan_sql(PLANE, ['a', 'b'], EPS, MIN_POINTS)})")
def dbscan(spark, sf_dir):
    return db.dbscan(_plane(spark, sf_dir), ["a", "b"], EPS, MIN_POINTS).select("vec_id", "label")


# eight embedding columns
WIDE, WIDE_EPS, WIDE_MIN = [f"c{i}" for i in range(1, 9)], 0.2, 4
WIDE_ROWS = f"(SELECT vec_id, {', '.join(f'CAST(embedding[{i}] AS DOUBLE) AS c{i}' for i in range(1, 9))} FROM embeddings)"


def _wide(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(WIDE)])


@query("eps_neighbours_wide", f"""
WITH p AS (SELECT DISTINCT {', '.join(WIDE)} FROM {WIDE_ROWS})
SELECT {', '.join('x.' + c for c in WIDE)}, count(*) AS n_neighbours FROM p x JOIN p y
  ON {' + '.join(f'(x.{c} - y.{c}) * (x.{c} - y.{c})' for c in WIDE)} <= CAST({WIDE_EPS} AS DOUBLE) * CAST({WIDE_EPS} AS DOUBLE)
GROUP BY {', '.join('x.' + c for c in WIDE)}
""")
def eps_neighbours_wide(spark, sf_dir):
    return neighbours.eps_neighbours(features.distinct_features(_wide(spark, sf_dir), WIDE), WIDE, WIDE_EPS)


@query("dbscan_wide", f"SELECT vec_id, label FROM ({_dbscan_sql(WIDE_ROWS, WIDE, WIDE_EPS, WIDE_MIN)})")
def dbscan_wide(spark, sf_dir):
    return db.dbscan(_wide(spark, sf_dir), WIDE, WIDE_EPS, WIDE_MIN).select("vec_id", "label")


# all embedding columns: pivots and rings instead of a grid
ALL, ALL_EPS, ALL_MIN = [f"c{i}" for i in range(1, 65)], 1.15, 5
ALL_ROWS = f"(SELECT vec_id, {', '.join(f'CAST(embedding[{i}] AS DOUBLE) AS c{i}' for i in range(1, 65))} FROM embeddings)"


def _all(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(ALL)])


@query("eps_neighbours_all", f"""
WITH p AS (SELECT DISTINCT {', '.join(ALL)} FROM {ALL_ROWS})
SELECT {', '.join('x.' + c for c in ALL)}, count(*) AS n_neighbours FROM p x JOIN p y
  ON {' + '.join(f'(x.{c} - y.{c}) * (x.{c} - y.{c})' for c in ALL)} <= CAST({ALL_EPS} AS DOUBLE) * CAST({ALL_EPS} AS DOUBLE)
GROUP BY {', '.join('x.' + c for c in ALL)}
""")
def eps_neighbours_all(spark, sf_dir):
    return metric.eps_neighbours(features.distinct_features(_all(spark, sf_dir), ALL), ALL, ALL_EPS)


@query("dbscan_all", f"SELECT vec_id, label FROM ({_dbscan_sql(ALL_ROWS, ALL, ALL_EPS, ALL_MIN)})")
def dbscan_all(spark, sf_dir):
    return metric.dbscan(_all(spark, sf_dir), ALL, ALL_EPS, ALL_MIN).select("vec_id", "label")


@query("kmeans_assign", f"SELECT vec_id, label FROM {ASSIGNED}")
def kmeans_assign(spark, sf_dir):
    return kmeans.assign(_plane(spark, sf_dir), ["a", "b"], CENTRES).select("vec_id", "label")


@query("kmeans_fit")
def kmeans_fit(spark, sf_dir):
    return kmeans.cluster(_plane(spark, sf_dir), ["a", "b"], 4).select("vec_id", "label")


@query("kmeans_fit_invariants", f"""
SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_labels, true AS all_nearest, true AS centres_are_means, true AS below_half FROM {PLANE}
""")
def kmeans_fit_invariants(spark, sf_dir):
    """What a finished fit must show: every row at its nearest centre, centres near the means of their distinct points, and a
    cost well below that of one cluster."""
    rows, columns = _plane(spark, sf_dir), ["a", "b"]
    model = kmeans.fit(rows, columns, 4)
    centres = kmeans.centroids(model)
    labelled = kmeans.assign(kmeans.predict(rows, columns, model), columns, centres, "nearest")
    distinct = labelled.select(*columns, "label").distinct()
    means = {r["label"]: (r["a"], r["b"]) for r in distinct.groupBy("label").agg(F.avg("a").alias("a"), F.avg("b").alias("b")).collect()}
    near = all(abs(x - y) < 0.02 for k, c in enumerate(centres) for x, y in zip(c, means[k]))
    whole = distinct.agg((F.var_pop("a") + F.var_pop("b")) * F.count("*")).first()[0]
    return labelled.agg(
        F.count("*").alias("n_rows"), F.countDistinct("label").alias("n_labels"),
        F.bool_and(F.col("label") == F.col("nearest")).alias("all_nearest"), F.lit(near).alias("centres_are_means"),
        F.lit(model.summary.trainingCost < whole / 2).alias("below_half"))


@query("kmeans_save_load", "SELECT l_orderkey, l_quantity, l_discount, true AS same_label FROM lineitem")
def kmeans_save_load(spark, sf_dir):
    """Labels of a model that went through a file, against those of the model itself."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount")
    columns = ["l_quantity", "l_discount"]
    model = kmeans.fit(rows, columns, 3)
    path = kmeans.save(model, scratch_path(spark, "kmeans"))
    both = kmeans.predict(kmeans.predict(rows, columns, model), columns, kmeans.load(path), "loaded")
    return both.select("l_orderkey", *columns, (F.col("label") == F.col("loaded")).alias("same_label"))


PAIRS = """(SELECT x.a, x.b, x.label, y.label AS other, sum({d}) AS total, count(*) AS n
  FROM p x, p y GROUP BY x.a, x.b, x.label, y.label)"""
SCORE = f"""
WITH p AS MATERIALIZED (SELECT DISTINCT a, b, label FROM {{points}}),
 s AS (SELECT a, b, label, max(CASE WHEN other = label THEN n END) AS size,
              max(CASE WHEN other = label AND n > 1 THEN total / (n - 1) END) AS mine,
              min(CASE WHEN other <> label THEN total / n END) AS next FROM {PAIRS} GROUP BY a, b, label)
SELECT round(avg(CASE WHEN size = 1 THEN 0 ELSE (next - mine) / greatest(mine, next) END), 6) AS silhouette,
       count(*) AS n_points FROM s
"""
SQUARE = "(x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)"
LOTS = """(SELECT l_quantity AS a, l_discount AS b, CASE WHEN l_quantity < 17.5 THEN 0 WHEN l_quantity < 32.5 THEN 1 ELSE 2 END AS label
  FROM lineitem)"""


@query("silhouette_exact", SCORE.replace("{points}", LOTS).replace("{d}", f"sqrt({SQUARE})"))
def silhouette_exact(spark, sf_dir):
    """Quantity and discount of all lines: the table may grow, their distinct tuples are
    bounded by the domain, which keeps the quadratic score affordable."""
    tuples = features.distinct_features(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"]).toDF("a", "b")
    labelled = kmeans.assign(tuples, ["a", "b"], [(10.0, 0.05), (25.0, 0.05), (40.0, 0.05)])
    return silhouette.silhouette_exact(labelled, ["a", "b"]).withColumn("silhouette", F.round("silhouette", 6))


@query("silhouette_interval", f"SELECT n_points, silhouette, true AS holds, true AS narrow FROM ({SCORE.replace('{points}', LOTS).replace('{d}', f'sqrt({SQUARE})')})")
def silhouette_interval(spark, sf_dir):
    """The interval of the same tuples' score, at most 0.02 wide, with the exact score in it."""
    tuples = features.distinct_features(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"]).toDF("a", "b")
    labelled = cut_lineage(kmeans.assign(tuples, ["a", "b"], [(10.0, 0.05), (25.0, 0.05), (40.0, 0.05)]))
    found = silhouette_bounds.silhouette_bounds(labelled, ["a", "b"], width=0.02)
    exact = silhouette.silhouette_exact(labelled, ["a", "b"]).select(F.col("silhouette").alias("exact"))
    return found.join(F.broadcast(exact)).select(
        "n_points", F.round("exact", 6).alias("silhouette"), F.col("exact").between(F.col("low") - 1e-9, F.col("high") + 1e-9).alias("holds"),
        (F.col("high") - F.col("low") <= 0.02).alias("narrow"))


@query("silhouette_squared", SCORE.replace("{points}", ASSIGNED).replace("{d}", SQUARE))
def silhouette_squared(spark, sf_dir):
    points = _labelled(spark, sf_dir)
    score = silhouette.silhouette_squared(points, ["a", "b"])
    return points.agg(F.lit(round(score, 6)).alias("silhouette"), F.count("*").alias("n_points"))


@query("silhouette_dbscan", SCORE.replace("{points}", f"(SELECT a, b, label FROM ({_dbscan_sql(PLANE, ['a', 'b'], EPS, MIN_POINTS)}))").replace("{d}", SQUARE))
def silhouette_dbscan(spark, sf_dir):
    """The squared score of the `dbscan` query's labels, each noise point a cluster of its own."""
    points = db.dbscan(_plane(spark, sf_dir).select("a", "b").distinct(), ["a", "b"], EPS, MIN_POINTS)
    points = cut_lineage(points.select("a", "b", "label"))
    score = silhouette.silhouette_squared(points, ["a", "b"])
    return points.agg(F.lit(round(score, 6)).alias("silhouette"), F.count("*").alias("n_points"))
