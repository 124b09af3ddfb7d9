"""SQL families reachable through the SQL front door, one user query per family.

Every query scans its whole input tables. Where Spark and ANSI/DuckDB spelling
differ, the second text is the counterpart; otherwise one text serves both.
"""

from lakekit.plans.registry import sql_query

# ---------------------------------------------------------------- projection, predicates

sql_query("sql_project", "lineitem", """
SELECT l_orderkey, l_linenumber, l_quantity * 2 AS qty2,
       round(l_extendedprice * (1 - l_discount), 4) AS net,
       CAST(floor(l_quantity / 7) AS BIGINT) AS packs,
       CASE WHEN l_discount >= 0.07 THEN 'high' WHEN l_discount > 0 THEN 'low' ELSE 'none' END AS band
FROM {lineitem}
""")

sql_query("sql_filter", "lineitem", """
SELECT l_orderkey, l_partkey, l_quantity, l_shipdate IS NULL AS no_date
FROM {lineitem}
WHERE l_quantity BETWEEN 10 AND 30 AND l_returnflag IN ('A', 'R')
  AND (l_discount > 0.03 OR NOT l_linestatus = 'F') AND l_tax IS NOT NULL
""")

sql_query("sql_like", "part", """
SELECT p_partkey, p_name LIKE 'red%' AS is_red, p_name ILIKE '%WIDGET' AS is_widget,
       regexp_like(p_brand, '^Brand#1[0-9]$') AS is_teen
FROM {part} WHERE p_name LIKE '%i%'
""", """
SELECT p_partkey, p_name LIKE 'red%' AS is_red, p_name ILIKE '%WIDGET' AS is_widget,
       regexp_matches(p_brand, '^Brand#1[0-9]$') AS is_teen
FROM part WHERE p_name LIKE '%i%'
""")

# ---------------------------------------------------------------- joins

sql_query("sql_join_inner", "orders customer nation", """
SELECT n_name, c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
GROUP BY n_name, c_mktsegment
""")

# The n-side of each outer join is pre-aggregated on the join key, so at most
# one row per key reaches the join and a hot customer costs one partial sum.
sql_query("sql_join_left", "orders customer", """
WITH per AS (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders} GROUP BY o_custkey)
SELECT c_custkey, c_name, coalesce(n, 0) AS n_orders, total
FROM {customer} LEFT JOIN per ON c_custkey = o_custkey
""")

sql_query("sql_join_right", "supplier customer", """
WITH big AS (SELECT s_nationkey, count(*) AS n_supp FROM {supplier} WHERE s_acctbal > 5000 GROUP BY s_nationkey),
     cust AS (SELECT c_nationkey, count(*) AS n_cust FROM {customer} GROUP BY c_nationkey)
SELECT c_nationkey, n_cust, n_supp FROM big RIGHT JOIN cust ON s_nationkey = c_nationkey
""")

sql_query("sql_join_full", "lineitem part", """
WITH sold AS (SELECT l_partkey, sum(l_quantity) AS qty FROM {lineitem} WHERE l_discount < 0.02 GROUP BY l_partkey),
     listed AS (SELECT p_partkey, p_size FROM {part} WHERE p_size > 10)
SELECT coalesce(l_partkey, p_partkey) AS partkey, qty, p_size
FROM sold FULL OUTER JOIN listed ON l_partkey = p_partkey
""")

sql_query("sql_join_semi", "orders lineitem", """
SELECT o_orderkey, o_orderpriority FROM {orders} LEFT SEMI JOIN {lineitem}
ON o_orderkey = l_orderkey AND l_quantity > 45
""", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE o_orderkey = l_orderkey AND l_quantity > 45)
""")

# NOT IN would force a null-aware anti join that broadcasts its right side;
# NOT EXISTS with the null test spelled out shuffles on the key instead.
sql_query("sql_join_anti", "orders customer", """
SELECT c_custkey, c_mktsegment FROM {customer}
WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
""", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'F')
""")

# The non-equi part rides on an equi key, so the join hashes instead of looping.
sql_query("sql_join_theta", "orders lineitem", """
SELECT o_orderpriority, count(*) AS n_late, round(sum(l_quantity), 2) AS qty
FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey
 AND l_shipdate > o_orderdate + INTERVAL '60' DAY AND l_extendedprice < o_totalprice
GROUP BY o_orderpriority
""")

sql_query("sql_lateral", "customer orders", """
SELECT c_custkey, x.top_price, x.n
FROM {customer}, LATERAL (SELECT max(o_totalprice) AS top_price, count(*) AS n
                          FROM {orders} WHERE o_custkey = c_custkey) AS x
""")

# ---------------------------------------------------------------- aggregation

sql_query("sql_groupby", "lineitem", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price,
       round(avg(l_quantity), 6) AS avg_qty, min(l_discount) AS min_disc,
       max(l_tax) AS max_tax, count(*) AS count_order
FROM {lineitem} WHERE l_shipdate <= DATE '2001-09-02'
GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10
""")

sql_query("sql_distinct", "lineitem", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_supp,
       sum(DISTINCT l_quantity) AS sum_distinct_qty
FROM {lineitem} GROUP BY l_returnflag
""")

sql_query("sql_select_distinct", "lineitem", """
SELECT DISTINCT l_quantity, l_discount, l_returnflag FROM {lineitem}
""")

sql_query("sql_agg_filter", "orders", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done,
       round(sum(o_totalprice) FILTER (WHERE o_orderstatus <> 'F'), 2) AS open_total,
       min(o_orderkey) FILTER (WHERE o_totalprice > 400000) AS first_big
FROM {orders} GROUP BY o_orderpriority
""")

sql_query("sql_agg_stats", "lineitem", """
SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp,
       round(covar_samp(l_quantity, l_discount), 6) AS cs, round(covar_pop(l_quantity, l_tax), 6) AS cp,
       round(corr(l_quantity, l_extendedprice), 6) AS r,
       round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 3) AS icept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, regr_count(l_tax, l_quantity) AS n
FROM {lineitem} GROUP BY l_returnflag
""", """
SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp,
       round(covar_samp(l_quantity, l_discount), 6) AS cs, round(covar_pop(l_quantity, l_tax), 6) AS cp,
       round(corr(l_quantity, l_extendedprice), 6) AS r,
       round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 3) AS icept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, CAST(regr_count(l_tax, l_quantity) AS BIGINT) AS n
FROM lineitem GROUP BY l_returnflag
""")

# Exact percentiles: rows collapse to (group, value, count) before the
# percentile buffer sees them, so the buffer holds distinct values only.
sql_query("sql_percentile", "lineitem", """
WITH v AS (SELECT l_returnflag, l_quantity, count(*) AS c FROM {lineitem} GROUP BY l_returnflag, l_quantity)
SELECT l_returnflag, percentile(l_quantity, 0.5D, c) AS med, round(percentile(l_quantity, 0.9D, c), 6) AS p90
FROM v GROUP BY l_returnflag
""", """
SELECT l_returnflag, median(l_quantity) AS med,
       round(percentile_cont(0.9) WITHIN GROUP (ORDER BY l_quantity), 6) AS p90
FROM lineitem GROUP BY l_returnflag
""")

sql_query("sql_approx", "events", """
SELECT event_type, approx_count_distinct(user_id) AS n_users, approx_percentile(value, 0.5) AS med_value
FROM {events} GROUP BY event_type
""", check=False)

# The approximations held against exact counts: distinct users, and the share of
# rows up to the approximate median (rejoined as one row per event type).
sql_query("sql_approx_bounds", "events", """
WITH a AS (SELECT event_type AS kind, approx_count_distinct(user_id, 0.02D) AS users,
                  approx_percentile(value, 0.5D, 10000) AS med FROM {events} GROUP BY event_type)
SELECT event_type, abs(max(users) / count(DISTINCT user_id) - 1) < 0.08 AS distinct_close,
       abs(avg(CASE WHEN value <= med THEN 1D ELSE 0D END) - 0.5) < 0.02 AS median_close
FROM {events} JOIN a ON event_type = kind GROUP BY event_type
""", "SELECT DISTINCT event_type, true AS distinct_close, true AS median_close FROM events")

# Arrays hold distinct values of a small domain, so no group's array can grow
# with the data.
sql_query("sql_agg_collect", "orders", """
SELECT o_custkey, concat_ws(',', sort_array(collect_set(o_orderpriority))) AS priorities,
       bool_and(o_totalprice > 1000) AS all_paid, bool_or(o_orderstatus = 'P') AS any_partial,
       bit_and(o_orderkey) AS band, bit_or(o_orderkey) AS bor, bit_xor(o_orderkey) AS bxor,
       min_by(o_orderkey, o_totalprice) AS cheapest
FROM {orders} GROUP BY o_custkey
""", """
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities,
       bool_and(o_totalprice > 1000) AS all_paid, bool_or(o_orderstatus = 'P') AS any_partial,
       bit_and(o_orderkey) AS band, bit_or(o_orderkey) AS bor, bit_xor(o_orderkey) AS bxor,
       arg_min(o_orderkey, o_totalprice) AS cheapest
FROM orders GROUP BY o_custkey
""")

sql_query("sql_grouping_sets", "orders", """
SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INT) AS g, count(*) AS n
FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderpriority), ())
""")

sql_query("sql_rollup", "orders", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM {orders} GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
""")

sql_query("sql_cube", "lineitem", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty
FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)
""")

sql_query("sql_pivot_case", "orders", """
SELECT o_orderpriority, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS done,
       sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS open_,
       round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS partial_total
FROM {orders} GROUP BY o_orderpriority
""", """
SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS done,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_,
       round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS partial_total
FROM orders GROUP BY o_orderpriority
""")

sql_query("sql_pivot", "orders", """
SELECT * FROM (SELECT o_orderpriority, o_orderstatus, o_totalprice FROM {orders})
PIVOT (round(max(o_totalprice), 2) FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))
""", """
SELECT o_orderpriority, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS f,
       max(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS o,
       max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS p
FROM orders GROUP BY o_orderpriority
""")

# ---------------------------------------------------------------- windows
# Window partitions pair the entity with a day, week or year, so a long history
# of one entity spreads over many partitions.

sql_query("sql_window_rank", "orders", """
SELECT o_orderkey,
       CAST(row_number() OVER w AS BIGINT) AS rn, CAST(rank() OVER w2 AS BIGINT) AS rk,
       CAST(dense_rank() OVER w2 AS BIGINT) AS dr, CAST(ntile(4) OVER w AS BIGINT) AS nt,
       round(percent_rank() OVER w, 6) AS pr, round(cume_dist() OVER w, 6) AS cd
FROM {orders}
WINDOW w AS (PARTITION BY o_custkey, date_trunc('year', o_orderdate) ORDER BY o_totalprice DESC, o_orderkey),
       w2 AS (PARTITION BY o_custkey, date_trunc('year', o_orderdate) ORDER BY o_orderpriority)
""")

sql_query("sql_window_offset", "events", """
SELECT event_id, lag(value) OVER w AS prev_value, lead(value, 2, -1D) OVER w AS next2,
       first_value(value) OVER w AS first_v, nth_value(value, 2) OVER w AS second_v,
       last_value(value) OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_v
FROM {events}
WINDOW w AS (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id)
""", """
SELECT event_id, lag(value) OVER w AS prev_value, lead(value, 2, -1) OVER w AS next2,
       first_value(value) OVER w AS first_v, nth_value(value, 2) OVER w AS second_v,
       last_value(value) OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_v
FROM events
WINDOW w AS (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id)
""")

sql_query("sql_window_frame", "events", """
SELECT event_id,
       round(sum(value) OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts, event_id
             ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS last3,
       count(*) OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts
             RANGE BETWEEN INTERVAL '1' HOUR PRECEDING AND CURRENT ROW) AS hour_count
FROM {events}
""")

# A GROUPS frame over ts-hours is a RANGE frame over the dense rank of the hour.
sql_query("sql_window_groups", "events", """
WITH ranked AS (
  SELECT event_id, value, user_id, date_trunc('week', ts) AS d,
         dense_rank() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY date_trunc('hour', ts)) AS g
  FROM {events})
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id, d ORDER BY g
       RANGE BETWEEN 1 PRECEDING AND CURRENT ROW), 2) AS two_hours
FROM ranked
""", """
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id, date_trunc('week', ts)
       ORDER BY date_trunc('hour', ts) GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW), 2) AS two_hours
FROM events
""")

# row_number() = 1 lets Spark keep one row per key on the map side (WindowGroupLimit).
sql_query("sql_top1_per_group", "orders", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM {orders}) WHERE rn = 1
""", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1
""")

# ---------------------------------------------------------------- sort, limit, set operations

sql_query("sql_sort", "customer", """
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal FROM {customer}
ORDER BY segment ASC NULLS LAST, c_acctbal DESC NULLS FIRST, c_custkey
""")

sql_query("sql_topk", "orders", """
SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5
""")

sql_query("sql_union", "customer supplier", """
SELECT c_nationkey AS nationkey, 'c' AS side FROM {customer} WHERE c_acctbal > 0
UNION SELECT s_nationkey, 's' FROM {supplier}
UNION ALL SELECT s_nationkey, 'again' FROM {supplier} WHERE s_acctbal > 5000
""")

sql_query("sql_intersect", "lineitem part", """
SELECT l_partkey AS partkey FROM {lineitem} WHERE l_quantity > 40
INTERSECT SELECT p_partkey FROM {part} WHERE p_size < 25
""")

sql_query("sql_intersect_all", "lineitem orders", """
SELECT l_linestatus AS flag, CAST(l_linenumber AS BIGINT) AS n FROM {lineitem} WHERE l_discount > 0.05
INTERSECT ALL SELECT o_orderstatus, o_custkey % 8 FROM {orders}
""")

sql_query("sql_except", "customer orders", """
SELECT c_custkey AS custkey FROM {customer} EXCEPT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F'
""")

sql_query("sql_except_all", "orders customer", """
SELECT o_custkey AS custkey FROM {orders} EXCEPT ALL SELECT c_custkey FROM {customer}
""")

# ---------------------------------------------------------------- subqueries, CTEs

sql_query("sql_subquery", "lineitem part orders customer", """
SELECT l_orderkey, l_partkey, l_quantity FROM {lineitem} l
WHERE l_quantity < (SELECT 0.4 * avg(l_quantity) FROM {lineitem} i WHERE i.l_partkey = l.l_partkey)
  AND l_partkey IN (SELECT p_partkey FROM {part} WHERE p_type = 'PROMO')
  AND EXISTS (SELECT 1 FROM {orders} JOIN {customer} ON o_custkey = c_custkey
              WHERE o_orderkey = l_orderkey AND c_acctbal > 0)
  AND l_extendedprice > (SELECT avg(l_extendedprice) / 50 FROM {lineitem})
""")

sql_query("sql_cte", "lineitem supplier", """
WITH revenue AS (
  SELECT l_suppkey, sum(l_extendedprice * (1 - l_discount)) AS total
  FROM {lineitem} WHERE l_shipdate >= DATE '1996-01-01' GROUP BY l_suppkey),
 mean AS (SELECT avg(total) AS m FROM revenue)
SELECT s_suppkey, s_name, round(total, 4) AS revenue, total > (SELECT m FROM mean) AS above_mean
FROM {supplier} JOIN revenue ON s_suppkey = l_suppkey
""")

sql_query("sql_recursive_cte", "conversations", """
WITH RECURSIVE chain(conv_id, turn, chars) MAX RECURSION LEVEL 2147483647 AS (
  SELECT conv_id, turn, CAST(length(text) AS BIGINT) FROM {conversations} WHERE turn = 0
  UNION ALL
  SELECT n.conv_id, n.turn, c.chars + length(n.text)
  FROM chain c JOIN {conversations} n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1)
SELECT conv_id, turn, chars FROM chain LIMIT ALL
""", """
WITH RECURSIVE chain(conv_id, turn, chars) AS (
  SELECT conv_id, turn, CAST(length(text) AS BIGINT) FROM conversations WHERE turn = 0
  UNION ALL
  SELECT n.conv_id, n.turn, c.chars + length(n.text)
  FROM chain c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1)
SELECT conv_id, turn, chars FROM chain
""")

sql_query("sql_unnest", "embeddings", """
SELECT label, CAST(pos AS BIGINT) AS pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean_x, count(*) AS n
FROM {embeddings} LATERAL VIEW posexplode(embedding) AS pos, x GROUP BY label, pos
""", """
SELECT label, pos - 1 AS pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean_x, count(*) AS n
FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
GROUP BY label, pos
""")

sql_query("sql_values", "orders", """
SELECT d.label, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM {orders} JOIN (VALUES ('F', 'done'), ('O', 'open'), ('P', 'partial')) AS d(code, label)
  ON o_orderstatus = d.code GROUP BY d.label
""")

# ---------------------------------------------------------------- scalar families

sql_query("sql_string", "part", """
SELECT p_partkey, CAST(length(p_name) AS BIGINT) AS n, upper(p_name) AS u, lpad(p_brand, 12, '*') AS lp,
       rpad(p_type, 10, '.') AS rp, substr(p_name, 2, 4) AS sub, split_part(p_name, ' ', 1) AS w1,
       replace(p_name, 'e', '3') AS rep, concat_ws('/', p_brand, p_type) AS path,
       CAST(instr(p_name, ' ') AS BIGINT) AS sp, initcap(p_name) AS title, reverse(p_brand) AS rev,
       translate(p_name, 'aeiou', '12345') AS tr, startswith(p_name, 's') AS s, trim(concat('  ', p_type, ' ')) AS tm
FROM {part}
""", """
SELECT p_partkey, length(p_name) AS n, upper(p_name) AS u, lpad(p_brand, 12, '*') AS lp,
       rpad(p_type, 10, '.') AS rp, substr(p_name, 2, 4) AS sub, split_part(p_name, ' ', 1) AS w1,
       replace(p_name, 'e', '3') AS rep, concat_ws('/', p_brand, p_type) AS path,
       instr(p_name, ' ') AS sp,
       array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
       reverse(p_brand) AS rev, translate(p_name, 'aeiou', '12345') AS tr, starts_with(p_name, 's') AS s,
       trim(concat('  ', p_type, ' ')) AS tm
FROM part
""")

sql_query("sql_regex", "pages", r"""
SELECT page_id, regexp_replace(url, '[0-9]+', '#') AS shape, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
       CAST(regexp_count(html, '<p[ >]') AS BIGINT) AS n_par,
       array_join(regexp_extract_all(url, '([a-z]+)=', 1), ',') AS params
FROM {pages}
""", r"""
SELECT page_id, regexp_replace(url, '[0-9]+', '#', 'g') AS shape, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
       CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS n_par,
       array_to_string(regexp_extract_all(url, '([a-z]+)=', 1), ',') AS params
FROM pages
""")

sql_query("sql_datetime", "orders", """
SELECT o_orderkey, date_format(date_trunc('quarter', o_orderdate), 'yyyy-MM-dd') AS q,
       CAST(extract(YEAR FROM o_orderdate) AS BIGINT) AS y, CAST(date_part('doy', o_orderdate) AS BIGINT) AS doy,
       CAST(dayofweek(o_orderdate) - 1 AS BIGINT) AS dow,
       date_format(o_orderdate + INTERVAL '1' MONTH, 'yyyy-MM-dd') AS plus_month,
       CAST(datediff(DATE '2002-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS age,
       date_format(last_day(o_orderdate), 'yyyy-MM-dd') AS month_end,
       date_format(to_timestamp(concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 12:30:00')), 'HH:mm') AS noon
FROM {orders}
""", """
SELECT o_orderkey, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS q,
       extract(YEAR FROM o_orderdate) AS y, date_part('doy', o_orderdate) AS doy,
       date_part('dow', o_orderdate) AS dow,
       strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS plus_month,
       date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age,
       strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end,
       strftime(strptime(strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00', '%Y-%m-%d %H:%M:%S'), '%H:%M') AS noon
FROM orders
""")

sql_query("sql_date_bin", "events", """
SELECT event_type, CAST(floor(unix_micros(CAST(ts AS TIMESTAMP)) / 1e6 / 900) * 900 AS BIGINT) AS bin,
       count(*) AS n, round(sum(value), 2) AS total
FROM {events} GROUP BY 1, 2
""", """
SELECT event_type, CAST(epoch(time_bucket(INTERVAL '15 minutes', ts)) AS BIGINT) AS bin,
       count(*) AS n, round(sum(value), 2) AS total
FROM events GROUP BY 1, 2
""")

sql_query("sql_math", "lineitem", """
SELECT l_orderkey, l_partkey, abs(l_discount - 0.05) AS a, CAST(ceil(l_extendedprice) AS BIGINT) AS ce,
       CAST(floor(l_extendedprice) AS BIGINT) AS fl, round(sqrt(l_quantity), 6) AS sq,
       round(ln(l_quantity), 6) AS lg, round(exp(l_discount), 6) AS ex, round(sin(l_quantity), 6) AS si,
       round(atan2(l_tax, l_quantity), 6) AS at, l_partkey % 7 AS md,
       CAST(sign(l_discount - 0.05) AS BIGINT) AS sg, round(try_divide(l_extendedprice, l_discount), 2) AS dv
FROM {lineitem}
""", """
SELECT l_orderkey, l_partkey, abs(l_discount - 0.05) AS a, CAST(ceil(l_extendedprice) AS BIGINT) AS ce,
       CAST(floor(l_extendedprice) AS BIGINT) AS fl, round(sqrt(l_quantity), 6) AS sq,
       round(ln(l_quantity), 6) AS lg, round(exp(l_discount), 6) AS ex, round(sin(l_quantity), 6) AS si,
       round(atan2(l_tax, l_quantity), 6) AS at, l_partkey % 7 AS md,
       CAST(sign(l_discount - 0.05) AS BIGINT) AS sg,
       round(CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice / l_discount END, 2) AS dv
FROM lineitem
""")

sql_query("sql_conditional", "customer", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS seg,
       greatest(c_acctbal, 100.5D, nullif(c_acctbal, c_acctbal)) AS g,
       least(c_nationkey, 10, CAST(NULL AS INT)) AS l, if(c_acctbal > 0, 'plus', 'minus') AS s,
       nvl(nullif(c_nationkey, 3), -1) AS n
FROM {customer}
""", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS seg,
       greatest(c_acctbal, 100.5, nullif(c_acctbal, c_acctbal)) AS g,
       least(c_nationkey, 10, CAST(NULL AS INT)) AS l, CASE WHEN c_acctbal > 0 THEN 'plus' ELSE 'minus' END AS s,
       coalesce(nullif(c_nationkey, 3), -1) AS n
FROM customer
""")

sql_query("sql_array", "embeddings", """
SELECT vec_id, CAST(size(embedding) AS BIGINT) AS n, array_contains(embedding, embedding[0]) AS has_first,
       CAST(element_at(array_sort(embedding), 1) AS DOUBLE) AS lo,
       CAST(element_at(sort_array(embedding, false), 1) AS DOUBLE) AS hi,
       CAST(array_position(embedding, array_max(embedding)) AS BIGINT) AS argmax,
       CAST(size(array_distinct(transform(embedding, x -> round(CAST(x AS DOUBLE), 1)))) AS BIGINT) AS n_distinct,
       CAST(size(concat(slice(embedding, 2, 3), slice(embedding, 1, 2))) AS BIGINT) AS five,
       CAST(size(filter(embedding, x -> x > 0)) AS BIGINT) AS n_pos
FROM {embeddings}
""", """
SELECT vec_id, len(embedding) AS n, list_contains(embedding, embedding[1]) AS has_first,
       CAST(list_sort(embedding)[1] AS DOUBLE) AS lo, CAST(list_reverse_sort(embedding)[1] AS DOUBLE) AS hi,
       CAST(list_position(embedding, list_max(embedding)) AS BIGINT) AS argmax,
       len(list_distinct(list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 1)))) AS n_distinct,
       len(list_concat(embedding[2:4], embedding[1:2])) AS five,
       len(list_filter(embedding, lambda x: x > 0)) AS n_pos
FROM embeddings
""")

sql_query("sql_struct_map", "orders", """
SELECT o_orderkey, named_struct('st', o_orderstatus, 'pr', o_totalprice).pr AS price,
       map('status', o_orderstatus, 'priority', o_orderpriority)['priority'] AS prio,
       element_at(map_keys(map('status', o_orderstatus, 'priority', o_orderpriority)), 1) AS k1
FROM {orders}
""", """
SELECT o_orderkey, struct_pack(st := o_orderstatus, pr := o_totalprice).pr AS price,
       map {'status': o_orderstatus, 'priority': o_orderpriority}['priority'] AS prio,
       map_keys(map {'status': o_orderstatus, 'priority': o_orderpriority})[1] AS k1
FROM orders
""")

sql_query("sql_json", "events", """
SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k,
       from_json(props, 'k INT').k * 2 AS k2, get_json_object(props, '$.missing') AS missing
FROM {events}
""", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract_string(props, '$.k') AS INT) * 2 AS k2, json_extract_string(props, '$.missing') AS missing
FROM events
""")

sql_query("sql_hash", "pages", """
SELECT page_id, md5(url) AS m, sha2(html, 256) AS s, base64(CAST(url AS BINARY)) AS b,
       lower(hex(page_id)) AS h, upper(hex(encode(substr(url, 1, 5), 'UTF-8'))) AS hx
FROM {pages}
""", """
SELECT page_id, md5(url) AS m, sha256(html) AS s, base64(encode(url)) AS b,
       lower(to_hex(page_id)) AS h, upper(hex(substr(url, 1, 5))) AS hx
FROM pages
""")

sql_query("sql_cast", "orders", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING) AS dec2,
       CAST(o_orderkey AS STRING) AS s, CAST(o_orderdate AS DATE) = DATE '1998-10-03' AS that_day,
       try_cast(substr(o_orderpriority, 1, 1) AS INT) AS p, try_cast(o_orderpriority AS INT) AS bad,
       CAST(o_custkey AS DOUBLE) / 4 AS quarter, CAST(o_orderstatus = 'F' AS INT) AS flag
FROM {orders} WHERE o_orderdate + INTERVAL '2' DAY > DATE '1995-02-01'
""", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS dec2,
       CAST(o_orderkey AS VARCHAR) AS s, CAST(o_orderdate AS DATE) = DATE '1998-10-03' AS that_day,
       try_cast(substr(o_orderpriority, 1, 1) AS INT) AS p, try_cast(o_orderpriority AS INT) AS bad,
       CAST(o_custkey AS DOUBLE) / 4 AS quarter, CAST(o_orderstatus = 'F' AS INT) AS flag
FROM orders WHERE o_orderdate + INTERVAL '2' DAY > DATE '1995-02-01'
""")
