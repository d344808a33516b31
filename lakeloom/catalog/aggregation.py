"""Aggregation (2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalog._sql import emean, hu
from lakeloom.functions.literals import exact_mean, half_up
from lakeloom.operators import aggregates as A
from lakeloom.operators import sketches
from lakeloom.plans import durable, ordered, skew
from lakeloom.registry import query


@query("agg_01_hash", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, round(sum(l_extendedprice), 2) AS price,
 round(avg(l_discount), 6) AS avg_disc, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY ALL
""")
def hash_agg(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))


@query("agg_02_count_distinct", """
SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT ts::DATE) AS days, count(DISTINCT props) AS props
FROM events GROUP BY 1
""")
def distinct(t):
    return t.events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct(F.to_date("ts")).alias("days"),
        F.count_distinct("props").alias("props"))


@query("agg_03_conditional", """
SELECT user_id, sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS spent,
 count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1
""")
def conditional(t):
    return t.events.groupBy("user_id").agg(
        F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)), 4).alias("spent"),
        F.count_if(F.col("event_type") == "error").alias("errors"))


@query("agg_04_safe_ratio", """
SELECT user_id, round(count(*) FILTER (WHERE event_type = 'click') * 100.0 /
  greatest(count(*) FILTER (WHERE event_type = 'view'), 1), 2) AS ctr,
 """ + hu(emean("CASE WHEN event_type = 'purchase' THEN value END"), 4) + """ AS per_purchase FROM events GROUP BY 1
""")
def safe_ratio(t):
    def kind(k):
        return F.col("event_type") == k

    return t.events.groupBy("user_id").agg(
        F.round(F.count_if(kind("click")) * 100.0 / F.greatest(F.count_if(kind("view")), F.lit(1)), 2).alias("ctr"),
        half_up(exact_mean(F.when(kind("purchase"), F.col("value"))), 4).alias("per_purchase"))


@query("agg_05_having", """
SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1 HAVING count(*) > 12
""")
def having(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders")).filter("orders > 12")


@query("agg_06_grouping_sets", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
""")
def grouping_sets(t):
    t.views("orders")
    return t.spark.sql(
        "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders"
        " GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")


@query("agg_07_cube", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""")
def cube(t):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("qty"))


@query("agg_08_rollup", """
SELECT year(o_orderdate) AS year, o_orderstatus, grouping_id(year(o_orderdate), o_orderstatus) AS level,
 count(*) AS n FROM orders GROUP BY ROLLUP (year(o_orderdate), o_orderstatus)
""")
def rollup(t):
    base = t.orders.select(F.year("o_orderdate").cast("bigint").alias("year"), "o_orderstatus")
    return base.rollup("year", "o_orderstatus").agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


@query("agg_09_exact_percentiles", """
SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
 round(quantile_cont(value, 0.99), 6) AS p99, round(quantile_cont(value, 0.999), 6) AS p999 FROM events GROUP BY 1
""")
def percentiles(t):
    probs = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p999": 0.999}
    q = ordered.exact_quantiles(t.events, ["event_type"], "value", probs, width=1.0)
    return q.select("event_type", *[F.round(p, 6).alias(p) for p in probs])


@query("agg_10_approx_percentile", """
SELECT event_type, true AS close FROM events GROUP BY 1
""")
def approx_percentile(t):
    est = t.events.groupBy("event_type").agg(F.percentile_approx("value", 0.95, 10000).alias("p95"))
    err = A.rank_error(t.events, ["event_type"], "value", est, "p95", 0.95)
    return err.select("event_type", (F.col("rank_error") <= 0.001).alias("close"))


@query("agg_11_stddev", """
SELECT o_custkey, round(stddev_samp(o_totalprice), 4) AS sd FROM orders GROUP BY 1
""")
def stddev(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.stddev("o_totalprice"), 4).alias("sd"))


@query("agg_12_mode", """
SELECT user_id, event_type AS top, n AS top_count FROM
 (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1
""")
def mode(t):
    return A.most_frequent(t.events, ["user_id"], "event_type")


@query("agg_13_bool_or", """
SELECT user_id, ts::DATE::VARCHAR AS day, bool_or(event_type = 'error') AS any_error,
 bool_and(value < 200) AS all_small FROM events GROUP BY ALL
""")
def bool_or(t):
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.bool_or(F.col("event_type") == "error").alias("any_error"), F.bool_and(F.col("value") < 200).alias("all_small"))


@query("agg_14_latest_row", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY 1
""")
def latest(t):
    row = F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id"))
    return t.events.groupBy("user_id").agg(row.alias("r")).select("user_id", "r.*")


@query("agg_15_top3_list", """
WITH s AS (SELECT o_custkey, o_orderpriority, sum(o_totalprice) AS w FROM orders GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY w DESC, o_orderpriority) AS rn FROM s)
SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY rn) AS top3 FROM r WHERE rn <= 3 GROUP BY 1
""")
def top3(t):
    return A.top_list(t.orders, ["o_custkey"], "o_orderpriority", F.col("o_totalprice"), 3, "top3")


@query("agg_16_collect_set", """
SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY 1
""")
def collect_set(t):
    return A.distinct_list(t.orders, ["o_custkey"], "o_orderstatus", "statuses")


@query("agg_17_time_bucket", """
SELECT to_timestamp((epoch(ts)::BIGINT // 300) * 300)::TIMESTAMP::VARCHAR AS slot, count(*) AS n,
 round(sum(value), 2) AS total FROM (SELECT date_trunc('second', ts) AS ts, value FROM events) GROUP BY 1
""")
def time_bucket(t):
    return t.events.groupBy(A.time_floor("ts", 300).alias("slot")).agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("agg_18_kll_quantiles", """
SELECT event_type, true AS close FROM events GROUP BY 1
""")
def kll(t):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.expr("kll_sketch_agg_double(value, 400)").alias("sketch"))
    merged = daily.groupBy("event_type").agg(F.expr("kll_merge_agg_double(sketch)").alias("sketch"))
    est = merged.select("event_type", F.expr("kll_sketch_get_quantile_double(sketch, 0.5D)").alias("p50"))
    err = A.rank_error(t.events, ["event_type"], "value", est, "p50", 0.5)
    return err.select("event_type", (F.col("rank_error") <= 0.02).alias("close"))


@query("agg_19_theta_set_algebra", """
SELECT op, true AS close FROM (VALUES ('union'), ('intersection'), ('difference')) v(op)
""")
def theta(t):
    def side(flag):
        return F.expr(f"theta_sketch_agg(o_custkey, 14) FILTER (WHERE o_orderpriority = '{flag}')")

    sk = t.orders.agg(side("1-URGENT").alias("a"), side("5-LOW").alias("b"))
    kinds = t.orders.groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("a"), F.bool_or(F.col("o_orderpriority") == "5-LOW").alias("b"))
    true_counts = kinds.agg(
        F.count_if(F.expr("a OR b")).alias("union"), F.count_if(F.expr("a AND b")).alias("intersection"),
        F.count_if(F.expr("a AND NOT b")).alias("difference"))
    est = sk.selectExpr(*[f"theta_sketch_estimate(theta_{o}(a, b)) AS {o}" for o in ("union", "intersection", "difference")])
    both = est.unpivot([], ["union", "intersection", "difference"], "op", "estimate").join(
        true_counts.unpivot([], ["union", "intersection", "difference"], "op", "truth"), "op")
    # the error of an intersection or difference scales with the union
    return both.select("op", (F.abs(F.col("estimate") - F.col("truth")) <= true_counts.select("union").scalar() * 0.05).alias("close"))


@query("agg_20_approx_top_k", """
SELECT item, n FROM (SELECT o_orderpriority AS item, count(*) AS n FROM orders GROUP BY 1)
""")
def approx_top_k(t):
    t.views("orders")
    return t.spark.sql(
        "SELECT c.item, c.count AS n FROM (SELECT explode(approx_top_k(o_orderpriority, 5, 1000)) AS c FROM orders)")


@query("agg_21_distinct_and_sum_sketch", """
SELECT event_type, round(sum(value), 2) AS revenue, true AS close FROM events GROUP BY 1
""")
def distinct_sum(t):
    per = t.events.groupBy("event_type").agg(
        F.round(F.sum("value"), 2).alias("revenue"), F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 14)).alias("est"))
    truth = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    return per.join(truth, "event_type").select(
        "event_type", "revenue", (F.abs(F.col("est") - F.col("users")) <= F.col("users") * 0.03).alias("close"))


@query("agg_21b_tuple_sketch_sets", """
WITH u AS (SELECT event_type, user_id, sum(value) AS total FROM events GROUP BY 1, 2),
 n AS (SELECT event_type, count(*) AS items FROM u GROUP BY 1)
SELECT x.event_type AS a, y.event_type AS b, count(*)::DOUBLE AS in_both, (any_value(p.items) + any_value(q.items) - count(*))::DOUBLE AS in_either,
 (any_value(p.items) - count(*))::DOUBLE AS only_a, round(sum(x.total), 2) AS total_a_in_both, round(sum(y.total), 2) AS total_b_in_both
FROM u x JOIN u y ON x.user_id = y.user_id AND x.event_type < y.event_type JOIN n p ON p.event_type = x.event_type JOIN n q ON q.event_type = y.event_type GROUP BY 1, 2
""")
def sketch_sets(t):
    """Users and revenue of each two event types from one sketch; exact up to 65,536 users of a type, as on the given tables."""
    sketch = durable.cut(sketches.tuple_sketch(t.events, ["event_type"], F.col("user_id"), F.col("value"), 65_536), "sketch")
    out = sketches.compared(sketch, "event_type")
    return out.withColumns({c: F.round(c, 2) for c in ("total_a_in_both", "total_b_in_both")})


@query("agg_22_column_statistics", """
SELECT count(*) AS rows, count(*) FILTER (WHERE o_totalprice IS NULL) AS o_totalprice_nulls,
 count(DISTINCT o_totalprice) AS o_totalprice_distinct, count(DISTINCT o_custkey) AS o_custkey_distinct,
 min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
 count(*) FILTER (WHERE o_custkey IS NULL) AS o_custkey_nulls, min(o_custkey) AS o_custkey_min,
 max(o_custkey) AS o_custkey_max FROM orders
""")
def statistics(t):
    return A.stats_of(t.orders, ["o_totalprice", "o_custkey"])


@query("agg_23_any_value", """
SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority FROM orders GROUP BY 1
""")
def any_value(t):
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"))
