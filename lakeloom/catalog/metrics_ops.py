"""Semantic metrics, cost and operations analytics (2.14)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.catalog._sql import emean, esum, hu
from lakeloom.functions import conditional as C
from lakeloom.functions.literals import exact_mean, exact_sum, half_up, units
from lakeloom.operators import metrics as K
from lakeloom.plans import ordered
from lakeloom.registry import query

SALES = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"


def net():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


NET_SQL = "l_extendedprice * (1 - l_discount)"


def sales(t):
    """Sales metrics over one row per order.

    The lines are summed per order before the joins, so one row per order is shuffled instead of every
    line, and an order count is a plain count.
    """
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(units(net(), 4)).alias("net"), F.sum(units(F.col("l_extendedprice") * 0.7)).alias("goods"),
        F.count("*").alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    src = lines.join(t.orders, "o_orderkey").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))

    def total(c, digits):
        return F.sum(c).cast("double") / float(10**digits)

    revenue, orders, users = total("net", 4), F.count("*"), F.count_distinct("o_custkey")
    urgent = total(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("net")), 4)
    return K.MetricView(
        src,
        {"segment": F.col("c_mktsegment"), "month": F.date_format("o_orderdate", "yyyy-MM"), "year": F.year("o_orderdate").cast("bigint")},
        {
            "revenue": revenue, "orders": orders, "customers": users,
            "aov": half_up(revenue / orders, 2), "arpu": half_up(revenue / users, 2),
            "return_pct": half_up(F.sum("returned") * F.lit(100.0) / F.sum("lines"), 2),
            "margin_pct": half_up((revenue - total("goods", 2)) * 100 / revenue, 2),
            "urgent_revenue": urgent, "urgent_share": half_up(urgent * 100 / revenue, 2),
        },
        where=F.col("o_orderstatus") != "P")


REV = esum(NET_SQL, 4)


@query("met_01_metric_view", f"SELECT c_mktsegment AS segment, {REV} AS revenue, count(DISTINCT o_orderkey) AS orders FROM {SALES} WHERE o_orderstatus <> 'P' GROUP BY 1")
def metric_view(t):
    return sales(t).query(["segment"], ["revenue", "orders"])


@query("met_02_derived_measures", f"""
SELECT year(o_orderdate) AS year, {hu(REV + " / count(DISTINCT o_orderkey)", 2)} AS aov, {hu(REV + " / count(DISTINCT o_custkey)", 2)} AS arpu,
 {hu("count(*) FILTER (WHERE l_returnflag = 'R') * 100.0::DOUBLE / count(*)", 2)} AS return_pct,
 {hu(f"({REV} - {esum('l_extendedprice * 0.7::DOUBLE')}) * 100 / {REV}", 2)} AS margin_pct FROM {SALES} WHERE o_orderstatus <> 'P' GROUP BY 1
""")
def derived(t):
    return sales(t).query(["year"], ["aov", "arpu", "return_pct", "margin_pct"])


URGENT = esum(f"CASE WHEN o_orderpriority = '1-URGENT' THEN {NET_SQL} END", 4)


@query("met_03_filtered_measures", f"""
SELECT c_mktsegment AS segment, {URGENT} AS urgent_revenue, {hu(f"{URGENT} * 100 / {REV}", 2)} AS urgent_share FROM {SALES} WHERE o_orderstatus <> 'P' GROUP BY 1
""")
def filtered(t):
    return sales(t).query(["segment"], ["urgent_revenue", "urgent_share"])


@query("met_04_segment_growth", f"""
WITH m AS (SELECT c_mktsegment AS segment, strftime(o_orderdate, '%Y-%m') AS month, {REV} AS revenue, count(DISTINCT o_custkey) AS customers,
  {hu(REV + " / count(DISTINCT o_orderkey)", 2)} AS aov FROM {SALES} WHERE o_orderstatus <> 'P' GROUP BY 1, 2)
SELECT segment, month, {hu("revenue", 2)} AS revenue, customers, aov,
 {hu("(revenue - lag(revenue) OVER w) / lag(revenue) OVER w * 100", 4)} AS growth_pct, rank() OVER (PARTITION BY month ORDER BY revenue DESC) AS revenue_rank
FROM m WINDOW w AS (PARTITION BY segment ORDER BY month)
""")
def segment_growth(t):
    monthly = K.with_growth(sales(t).query(["segment", "month"], ["revenue", "customers", "aov"]), ["segment"], "month", "revenue")
    place = F.rank().over(W.partitionBy("month").orderBy(F.desc("revenue"))).cast("bigint")
    return monthly.select("segment", "month", half_up(F.col("revenue"), 2).alias("revenue"), "customers", "aov",
                          half_up(F.col("growth_pct"), 4).alias("growth_pct"), place.alias("revenue_rank"))


@query("met_05_alerts", """
WITH m AS (SELECT 'n_' || event_type AS metric, count(*)::DOUBLE AS value FROM events GROUP BY 1),
 a AS (FROM (VALUES ('many errors', 'n_error', '>', 10.0::DOUBLE), ('few views', 'n_view', '<', 5.0::DOUBLE), ('sales', 'n_purchase', '>=', 1.0::DOUBLE)) a(alert, metric, operator, threshold))
SELECT alert, metric, value, operator, threshold FROM m JOIN a USING (metric) WHERE (operator = '>' AND value > threshold) OR (operator = '<' AND value < threshold) OR (operator = '>=' AND value >= threshold)
""")
def alerts(t):
    values = t.events.groupBy(F.concat(F.lit("n_"), "event_type").alias("metric")).agg(F.count("*").cast("double").alias("value"))
    table = t.spark.createDataFrame(
        [("many errors", "n_error", ">", 10.0), ("few views", "n_view", "<", 5.0), ("sales", "n_purchase", ">=", 1.0)],
        "alert string, metric string, operator string, threshold double")
    return K.evaluate_alerts(values, table)


@query("met_06_cost_report", f"""
SELECT json_extract_string(props, '$.k')::INT % 5 AS team, strftime(ts, '%Y-%m') AS month, {esum("value * 0.15::DOUBLE", 4)} AS cost, count(*) AS runs,
 count(*) FILTER (WHERE value < 1) AS idle_runs, count(*) FILTER (WHERE value > 200) AS expensive_runs FROM events GROUP BY 1, 2
""")
def cost(t):
    usage = t.events.withColumn("usage", F.struct(F.from_json("props", "k int").alias("tags"), F.col("value").alias("quantity")))
    return usage.groupBy((F.col("usage.tags.k") % 5).alias("team"), F.date_format("ts", "yyyy-MM").alias("month")).agg(
        exact_sum(F.col("usage.quantity") * 0.15, 4).alias("cost"), F.count("*").alias("runs"),
        F.count_if(F.col("usage.quantity") < 1).alias("idle_runs"), F.count_if(F.col("usage.quantity") > 200).alias("expensive_runs"))


@query("met_07_long_runs", f"""
WITH s AS (SELECT event_type, {emean("value")} AS mean, stddev_samp(value) AS sd FROM events GROUP BY 1)
SELECT event_id, event_type, value, round(sd, 4) AS sd FROM events JOIN s USING (event_type) WHERE value > 2 * mean
""")
def long_runs(t):
    stats = t.events.groupBy("event_type").agg(exact_mean("value").alias("mean"), F.stddev("value").alias("sd"))
    return t.events.join(stats, "event_type").filter("value > 2 * mean").select("event_id", "event_type", "value", F.round("sd", 4).alias("sd"))


@query("met_08_success_rate", f"""
SELECT ts::DATE::VARCHAR AS day, count(*) AS runs, {hu("count(*) FILTER (WHERE event_type <> 'error') * 100.0::DOUBLE / count(*)", 2)} AS success_pct FROM events GROUP BY ts::DATE
""")
def success(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("runs"), half_up(F.count_if(F.col("event_type") != "error") * F.lit(100.0) / F.count("*"), 2).alias("success_pct"))


@query("met_09_slo", f"""
SELECT ts::DATE::VARCHAR AS day, round(quantile_cont(value, 0.99), 6) AS p99, {hu("count(*) FILTER (WHERE event_type = 'error') * 100.0::DOUBLE / count(*)", 2)} AS error_pct,
 quantile_cont(value, 0.99) <= 230 AND count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*) <= 21 AS met FROM events GROUP BY ts::DATE
""")
def slo(t):
    base = t.events.withColumn("day", F.to_date("ts"))
    p99 = ordered.exact_quantiles(base, ["day"], "value", {"p99": 0.99}, 1.0)
    err = base.groupBy("day").agg((F.count_if(F.col("event_type") == "error") * F.lit(100.0) / F.count("*")).alias("e"))
    return p99.join(err, "day").select("day", F.round("p99", 6).alias("p99"), half_up(F.col("e"), 2).alias("error_pct"),
                                       ((F.col("p99") <= 230) & (F.col("e") <= 21)).alias("met"))


@query("met_10_weekly_trend", f"""
WITH k AS (SELECT date_trunc('week', ts)::DATE AS week, count(DISTINCT user_id) AS users, {esum("value")} AS total FROM events GROUP BY 1)
SELECT week::VARCHAR AS week, users, total, {hu("(total - lag(total) OVER (ORDER BY week)) / lag(total) OVER (ORDER BY week) * 100", 4)} AS growth_pct FROM k
""")
def weekly(t):
    k = t.events.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week")).agg(
        F.count_distinct("user_id").alias("users"), exact_sum("value").alias("total"))
    return K.with_growth(k, [], "week", "total").withColumn("growth_pct", half_up(F.col("growth_pct"), 4))


@query("met_11_funnel", f"""
WITH u AS (SELECT user_id, bool_or(value > 0) AS a, bool_or(event_type = 'view' AND value > 50) AS b, bool_or(event_type = 'click' AND value > 100) AS c,
  bool_or(event_type = 'purchase' AND value > 150) AS d FROM events GROUP BY 1),
 n AS (SELECT 'seen' AS stage, 1 AS step, count(*) FILTER (WHERE a) AS users FROM u UNION ALL SELECT 'viewed', 2, count(*) FILTER (WHERE b) FROM u
  UNION ALL SELECT 'clicked', 3, count(*) FILTER (WHERE c) FROM u UNION ALL SELECT 'bought', 4, count(*) FILTER (WHERE d) FROM u)
SELECT stage, step, users, {hu("users * 100 / lag(users) OVER (ORDER BY step)", 4)} AS rate FROM n
""")
def funnel(t):
    e, v = F.col("event_type"), F.col("value")
    stages = {"seen": v > 0, "viewed": (e == "view") & (v > 50), "clicked": (e == "click") & (v > 100), "bought": (e == "purchase") & (v > 150)}
    return K.funnel(t.events, "user_id", stages).withColumn("rate", half_up(F.col("rate"), 4))


@query("met_12_day_hour_peak", """
WITH c AS (SELECT dayofweek(ts) + 1 AS dow, hour(ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3)
SELECT dow, hour, sum(n)::BIGINT AS events, arg_max(event_type, (n, event_type)) AS peak_type FROM c GROUP BY 1, 2
""")
def peak(t):
    c = t.events.groupBy(F.dayofweek("ts").cast("bigint").alias("dow"), F.hour("ts").cast("bigint").alias("hour"), "event_type").agg(F.count("*").alias("n"))
    return c.groupBy("dow", "hour").agg(F.sum("n").alias("events"), F.max_by("event_type", F.struct("n", "event_type")).alias("peak_type"))


@query("met_13_user_segments", f"""
WITH d AS (SELECT user_id, {esum("value")} / count(DISTINCT ts::DATE) AS minutes FROM events GROUP BY 1)
SELECT CASE WHEN minutes >= 120 THEN 'heavy' WHEN minutes >= 60 THEN 'moderate' WHEN minutes >= 15 THEN 'light' ELSE 'dormant' END AS segment, count(*) AS users FROM d GROUP BY 1
""")
def segments(t):
    per = t.events.groupBy("user_id").agg((exact_sum("value") / F.count_distinct(F.to_date("ts"))).alias("minutes"))
    label = C.band_from(F.col("minutes"), [(120, "heavy"), (60, "moderate"), (15, "light")], "dormant")
    return per.groupBy(label.alias("segment")).agg(F.count("*").alias("users"))


@query("met_14_business_questions", f"""
WITH v AS (SELECT *, 'show_' || event_id % 20 AS program FROM events),
 p AS (SELECT program, count(DISTINCT user_id) AS viewers, {esum("value")} AS minutes FROM v GROUP BY 1)
SELECT 'top_program' AS question, program AS item, minutes AS result FROM (FROM p ORDER BY minutes DESC, program LIMIT 5)
UNION ALL SELECT 'weekday_minutes', CASE WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END, {esum("value")} FROM v GROUP BY 2
UNION ALL SELECT 'segment_minutes', c_mktsegment, {esum("value")} FROM v JOIN customer ON c_custkey = user_id GROUP BY 2
""")
def questions(t):
    v = t.events.withColumn("program", F.concat(F.lit("show_"), (F.col("event_id") % 20).cast("string")))
    minutes = exact_sum("value").alias("result")
    top = v.groupBy(F.col("program").alias("item")).agg(minutes).orderBy(F.desc("result"), "item").limit(5)
    week = v.groupBy(F.when(F.dayofweek("ts").isin(1, 7), "weekend").otherwise("weekday").alias("item")).agg(minutes)
    seg = v.join(t.customer, F.col("user_id") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("item")).agg(minutes)
    named = [df.select(F.lit(q).alias("question"), "item", "result") for q, df in
             (("top_program", top), ("weekday_minutes", week), ("segment_minutes", seg))]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("met_15_active_users", f"""
WITH d AS (SELECT ts::DATE AS day, count(DISTINCT user_id) AS dau FROM events GROUP BY 1), m AS (SELECT date_trunc('month', ts) AS mon, count(DISTINCT user_id) AS mau FROM events GROUP BY 1)
SELECT day::VARCHAR AS day, dau, mau, {hu("dau * 100.0::DOUBLE / mau", 2)} AS stickiness FROM d JOIN m ON date_trunc('month', day) = mon
""")
def active(t):
    d = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count_distinct("user_id").alias("dau"))
    m = t.events.groupBy(F.date_format("ts", "yyyy-MM").alias("mon")).agg(F.count_distinct("user_id").alias("mau"))
    return d.withColumn("mon", F.date_format("day", "yyyy-MM")).join(m, "mon").select(
        "day", "dau", "mau", half_up(F.col("dau") * F.lit(100.0) / F.col("mau"), 2).alias("stickiness"))


BUY = "event_type = 'purchase' AND value > 100"


@query("met_16_arpu_arppu", f"""
SELECT ts::DATE::VARCHAR AS day, {hu(esum(f"CASE WHEN {BUY} THEN value ELSE 0.0::DOUBLE END") + " / count(DISTINCT user_id)", 4)} AS arpu,
 {hu(esum(f"CASE WHEN {BUY} THEN value ELSE 0.0::DOUBLE END") + f" / nullif(count(DISTINCT CASE WHEN {BUY} THEN user_id END), 0)", 4)} AS arppu FROM events GROUP BY ts::DATE
""")
def arpu(t):
    paid = F.expr(BUY)
    revenue = exact_sum(F.when(paid, F.col("value")).otherwise(0.0))
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        half_up(F.try_divide(revenue, F.count_distinct("user_id")), 4).alias("arpu"),
        half_up(F.try_divide(revenue, F.count_distinct(F.when(paid, F.col("user_id")))), 4).alias("arppu"))


@query("met_17_conversion_rate", f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, {hu(f"count(DISTINCT CASE WHEN {BUY} THEN user_id END) * 100.0::DOUBLE / count(DISTINCT user_id)", 2)} AS conversion_pct FROM events GROUP BY 1
""")
def conversion(t):
    payers = F.count_distinct(F.when(F.expr(BUY), F.col("user_id")))
    return t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        half_up(payers * F.lit(100.0) / F.count_distinct("user_id"), 2).alias("conversion_pct"))


@query("met_18_cohort_retention", f"""
WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events), f AS (SELECT user_id, min(day) AS cohort FROM d GROUP BY 1),
 s AS (SELECT cohort, count(*) AS cohort_users FROM f GROUP BY 1)
SELECT cohort::VARCHAR AS cohort, (day - cohort)::INT AS day_offset, count(*) AS retained, cohort_users, {hu("count(*) * 100.0::DOUBLE / cohort_users", 2)} AS retention_pct
FROM d JOIN f USING (user_id) JOIN s USING (cohort) GROUP BY f.cohort, 2, cohort_users
""")
def retention(t):
    out = K.cohort_retention(t.events, "user_id", F.to_date("ts"))
    return out.withColumn("retention_pct", half_up(F.col("retention_pct"), 2))


@query("met_19_engagement_rate", f"SELECT event_type, {hu('count(*) / count(DISTINCT user_id)', 4)} AS per_user FROM events GROUP BY 1")
def engagement(t):
    return t.events.groupBy("event_type").agg(half_up(F.try_divide(F.count("*"), F.count_distinct("user_id")), 4).alias("per_user"))


@query("met_20_cross_source_top", f"""
WITH u AS (SELECT 'web' AS platform, 'show_' || event_id % 50 AS content, ts::DATE AS day, value AS engagement FROM events WHERE event_type = 'view'
 UNION ALL SELECT 'shop', 'part_' || l_partkey, l_shipdate::DATE, l_quantity FROM lineitem)
SELECT platform, content, {esum("engagement")} AS engagement, max(day)::VARCHAR AS last_day FROM u GROUP BY 1, 2 ORDER BY engagement DESC, platform, content LIMIT 20
""")
def cross_source(t):
    web = t.events.filter("event_type = 'view'").select(
        F.lit("web").alias("platform"), F.concat(F.lit("show_"), (F.col("event_id") % 50).cast("string")).alias("content"),
        F.to_date("ts").alias("day"), F.col("value").alias("engagement"))
    shop = t.lineitem.select(
        F.lit("shop").alias("platform"), F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("content"),
        F.to_date("l_shipdate").alias("day"), F.col("l_quantity").alias("engagement"))
    both = web.unionByName(shop).groupBy("platform", "content").agg(exact_sum("engagement").alias("engagement"), F.max("day").alias("last_day"))
    return both.orderBy(F.desc("engagement"), "platform", "content").limit(20)


@query("met_21_before_after", f"""
SELECT n_name, {hu(emean("o_totalprice", 2, "o_orderdate < TIMESTAMP '1998-01-01'"), 2)} AS before, {hu(emean("o_totalprice", 2, "o_orderdate >= TIMESTAMP '1998-01-01'"), 2)} AS after
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def before_after(t):
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    price = F.col("o_totalprice")
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(half_up(exact_mean(F.when(early, price)), 2).alias("before"), half_up(exact_mean(F.when(~early, price)), 2).alias("after")))


@query("met_22_metric_at_any_grain", f"""
SELECT NULL::VARCHAR AS segment, year(o_orderdate) AS year, {hu(REV + " / count(DISTINCT o_orderkey)", 2)} AS aov FROM {SALES} WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'BUILDING' GROUP BY 2
UNION ALL SELECT c_mktsegment, NULL, {hu(REV + " / count(DISTINCT o_orderkey)", 2)} FROM {SALES} WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'BUILDING' GROUP BY 1
""")
def any_grain(t):
    view, only = sales(t), F.col("c_mktsegment") != "BUILDING"
    return view.query(["year"], ["aov"], only).unionByName(view.query(["segment"], ["aov"], only), allowMissingColumns=True)
