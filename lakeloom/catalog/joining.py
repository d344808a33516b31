"""Joins (2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.literals import ntz
from lakeloom.operators import joins
from lakeloom.plans import skew
from lakeloom.registry import query


def revenue():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


@query("jn_01_inner", """
SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def inner(t):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query("jn_02_left", """
SELECT c_custkey, count(o_orderkey) AS orders, coalesce(round(sum(o_totalprice), 2), 0) AS total,
 max(o_orderdate)::DATE::VARCHAR AS last_order
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1
""")
def left(t):
    stats = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("s"), F.max("o_orderdate").alias("last")
    )
    return t.customer.join(stats, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey",
        F.coalesce("n", F.lit(0)).alias("orders"),
        F.coalesce(F.round("s", 2), F.lit(0.0)).alias("total"),
        F.to_date("last").alias("last_order"),
    )


@query("jn_03_right", """
SELECT n_name, count(s_suppkey) AS suppliers FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1
""")
def right(t):
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right")
        .groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers"))
    )


@query("jn_04_full_three_way", """
WITH a AS (SELECT user_id, ts::DATE AS d, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY ALL),
 b AS (SELECT user_id, ts::DATE AS d, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY ALL),
 c AS (SELECT user_id, ts::DATE AS d, sum(value) AS spent FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT coalesce(a.user_id, b.user_id, c.user_id) AS user_id, coalesce(a.d, b.d, c.d)::VARCHAR AS day,
 coalesce(views, 0) AS views, coalesce(errors, 0) AS errors, round(coalesce(spent, 0), 2) AS spent
FROM a FULL JOIN b ON a.user_id = b.user_id AND a.d = b.d
FULL JOIN c ON coalesce(a.user_id, b.user_id) = c.user_id AND coalesce(a.d, b.d) = c.d
""")
def full_three(t):
    day = F.to_date("ts").alias("day")

    def side(kind, agg):
        return t.events.filter(F.col("event_type") == kind).groupBy("user_id", day).agg(agg)

    frames = [
        side("view", F.count("*").alias("views")),
        side("error", F.count("*").alias("errors")),
        side("purchase", F.sum("value").alias("spent")),
    ]
    return joins.full_join_on(frames, ["user_id", "day"]).select(
        "user_id", "day",
        F.coalesce("views", F.lit(0)).alias("views"),
        F.coalesce("errors", F.lit(0)).alias("errors"),
        F.round(F.coalesce("spent", F.lit(0.0)), 2).alias("spent"),
    )


@query("jn_05_share_of_one_row_total", """
SELECT event_type, count(DISTINCT user_id) AS viewers, round(count(DISTINCT user_id) * 100.0 /
 greatest((SELECT count(DISTINCT user_id) FROM events), 1), 2) AS reach_pct FROM events GROUP BY 1
""")
def one_row_total(t):
    everyone = t.events.agg(F.count_distinct("user_id"))
    per = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("viewers"))
    return per.withColumn(
        "reach_pct", F.round(F.col("viewers") * 100.0 / F.greatest(everyone.scalar(), F.lit(1)), 2)
    )


@query("jn_06_duplicate_links", """
WITH g AS (SELECT p_name, p_brand, p_type, min(p_partkey) AS first_id FROM part GROUP BY ALL)
SELECT first_id, p_partkey AS other_id, p_name, p_brand, p_type FROM part JOIN g USING (p_name, p_brand, p_type)
WHERE first_id < p_partkey
""")
def duplicate_links(t):
    return joins.linked_to_first(t.part, ["p_name", "p_brand", "p_type"], "p_partkey")


@query("jn_07_checked_broadcast", """
SELECT r_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def broadcast_join(t):
    places = t.nation.join(skew.checked_broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t.customer.join(skew.checked_broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name")
        .agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    )


@query("jn_08_merge_and_shuffle_hash", """
SELECT p_brand, count(*) AS lines, count(DISTINCT l_orderkey) AS orders FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def strategies(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(
        t.orders.select("o_orderkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return (
        lines.join(t.part.select("p_partkey", "p_brand").hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand")
        .agg(F.count("*").alias("lines"), F.count_distinct("l_orderkey").alias("orders"))
    )


@query("jn_09_salted", """
SELECT c_custkey, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
""")
def salted(t):
    custs = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return (
        skew.salted_join(t.orders, custs, ["o_custkey"], ["o_orderkey"])
        .groupBy(F.col("o_custkey").alias("c_custkey"), "c_mktsegment")
        .agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query("jn_10_asof", """
WITH f AS (SELECT user_id, ts, max_by(event_id, event_id) AS event_id, max_by(value, event_id) AS value
  FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT l.event_id AS label_id, l.user_id, f.event_id AS feature_id, f.value AS feature_value
FROM events l ASOF LEFT JOIN f ON l.user_id = f.user_id AND l.ts >= f.ts
WHERE l.event_type = 'purchase'
""")
def asof(t):
    labels = t.events.filter("event_type = 'purchase'").select(F.col("event_id").alias("label_id"), "user_id", "ts")
    views = t.events.filter("event_type = 'view'").withColumn("tie", F.lpad(F.col("event_id").cast("string"), 20, "0"))
    outputs = {"feature_id": F.col("event_id"), "feature_value": F.col("value")}
    return joins.asof_join(labels, views, "user_id", "ts", "ts", outputs, "tie").drop("ts")


@query("jn_11_interval_left", """
SELECT i.event_id AS impression_id, c.event_id AS click_id
FROM (SELECT * FROM events WHERE event_type = 'view') i
LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
 ON i.user_id = c.user_id AND c.ts >= i.ts AND c.ts <= i.ts + INTERVAL 1 HOUR
""")
def interval(t):
    views = t.events.filter("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("impression_id"), F.col("ts").alias("impression_time"))
    clicks = t.events.filter("event_type = 'click'").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_time"))
    return joins.interval_join(views, clicks, "user_id", "impression_time", "click_time", 3600).select(
        "impression_id", "click_id"
    )


@query("jn_12_valid_at", """
WITH h AS (SELECT o_custkey AS customer, o_orderpriority AS tier, o_orderdate AS start_at,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS end_at FROM orders)
SELECT customer, tier, start_at::DATE::VARCHAR AS start_at, end_at::DATE::VARCHAR AS end_at FROM h
WHERE start_at <= TIMESTAMP '1998-01-01' AND (end_at > TIMESTAMP '1998-01-01' OR end_at IS NULL)
""")
def valid_at(t):
    from lakeloom.operators import history

    versions = t.orders.select(
        F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("tier"), "o_orderdate", "o_orderkey")
    hist = history.close_intervals(versions, ["customer"], ["o_orderdate", "o_orderkey"])
    return history.state_as_of(hist, ntz("1998-01-01")).select(
        "customer", "tier", F.to_date("start_at").alias("start_at"), F.to_date("end_at").alias("end_at"))


@query("jn_13_semi_anti", """
SELECT 'with_orders' AS side, count(*) AS n FROM customer WHERE EXISTS
 (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')
UNION ALL SELECT 'without', count(*) FROM customer WHERE NOT EXISTS
 (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')
""")
def semi_anti(t):
    recent = t.orders.filter(F.col("o_orderdate") >= ntz("2001-01-01"))
    on = F.col("o_custkey") == F.col("c_custkey")

    def counted(how, label):
        return t.customer.join(recent, on, how).agg(F.count("*").alias("n")).select(F.lit(label).alias("side"), "n")

    return counted("left_semi", "with_orders").unionByName(counted("left_anti", "without"))


@query("jn_14_overlap_minimum", """
SELECT c_mktsegment, count(DISTINCT c_custkey) AS matched FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
GROUP BY 1 HAVING count(DISTINCT c_custkey) >= 50
""")
def overlap(t):
    buyers = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.overlap_at_least(t.customer, buyers, "c_custkey", ["c_mktsegment"], 50)


@query("jn_15_top_lookup", """
WITH s AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
 top AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1)
SELECT c_custkey, c_mktsegment, o_orderpriority AS top_priority, n FROM customer LEFT JOIN top ON o_custkey = c_custkey
""")
def top_lookup(t):
    counts = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    top = skew.latest_per_key(counts, ["o_custkey"], [F.desc("n"), F.asc("o_orderpriority")])
    return t.customer.join(top, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", "c_mktsegment", F.col("o_orderpriority").alias("top_priority"), "n")


def _star(t):
    places = t.nation.join(skew.checked_broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(skew.checked_broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    )


@query("jn_16_star", """
SELECT r_name, p_type, year(o_orderdate) AS year, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
 count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL
""")
def star(t):
    return (
        _star(t).groupBy("r_name", "p_type", F.year("o_orderdate").cast("bigint").alias("year"))
        .agg(F.round(F.sum(revenue()), 4).alias("revenue"), F.count("*").alias("lines"))
    )


@query("jn_16b_star_by_fiscal_quarter", """
SELECT r_name, (CASE WHEN month(o_orderdate) >= 4 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END)::INT AS fiscal_year,
 CASE WHEN month(o_orderdate) < 4 THEN 'Q4' WHEN month(o_orderdate) < 7 THEN 'Q1' WHEN month(o_orderdate) < 10 THEN 'Q2' ELSE 'Q3' END AS fiscal_quarter,
 round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
WHERE dayofweek(o_orderdate) NOT IN (0, 6) AND strftime(o_orderdate, '%m-%d') NOT IN ('01-01', '05-01', '12-25')
GROUP BY ALL
""")
def star_by_fiscal_quarter(t):
    """Revenue of business days by region and fiscal quarter, both read from the date dimension (a row per day)."""
    day = F.to_date("o_orderdate")
    first, last = (t.orders.agg(f(day)).scalar() for f in (F.min, F.max))
    days = joins.calendar(first, last, t.spark, HOLIDAYS).filter("is_business_day").select("date", "fiscal_year", "fiscal_quarter")
    return _star(t).withColumn("order_day", day).join(days, F.col("order_day") == F.col("date")).groupBy("r_name", "fiscal_year", "fiscal_quarter").agg(
        F.round(F.sum(revenue()), 2).alias("revenue"), F.count("*").alias("lines"))


@query("jn_17_one_wide_table", """
SELECT l_orderkey, l_linenumber, o_orderdate::DATE::VARCHAR AS order_day, c_name, c_mktsegment, n_name, r_name,
 p_name, p_brand, l_quantity, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def wide(t):
    return _star(t).select(
        "l_orderkey", "l_linenumber", F.to_date("o_orderdate").alias("order_day"), "c_name", "c_mktsegment",
        "n_name", "r_name", "p_name", "p_brand", "l_quantity", "l_extendedprice")


HOLIDAYS = {"01-01": "New Year", "05-01": "Labour Day", "12-25": "Christmas Day"}


@query("jn_18_date_dimension", """
WITH d AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))::DATE AS date)
SELECT date::VARCHAR AS date, strftime(date, '%Y%m%d')::INT AS date_key, year(date)::INT AS year,
 quarter(date)::INT AS quarter, month(date)::INT AS month, day(date)::INT AS day, (dayofweek(date) + 1)::INT AS weekday,
 dayofweek(date) IN (0, 6) AS is_weekend, monthname(date) AS month_name, dayname(date) AS weekday_name, weekofyear(date)::INT AS week,
 strftime(date, '%Y-%m') AS year_month, (CASE WHEN month(date) >= 4 THEN year(date) ELSE year(date) - 1 END)::INT AS fiscal_year,
 CASE WHEN month(date) < 4 THEN 'Q4' WHEN month(date) < 7 THEN 'Q1' WHEN month(date) < 10 THEN 'Q2' ELSE 'Q3' END AS fiscal_quarter,
 CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '05-01' THEN 'Labour Day' WHEN '12-25' THEN 'Christmas Day' END AS holiday_name,
 strftime(date, '%m-%d') IN ('01-01', '05-01', '12-25') AS is_holiday,
 dayofweek(date) NOT IN (0, 6) AND strftime(date, '%m-%d') NOT IN ('01-01', '05-01', '12-25') AS is_business_day,
 count(o_orderkey) AS orders
FROM d LEFT JOIN orders ON o_orderdate::DATE = date GROUP BY ALL
""")
def date_dimension(t):
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("orders"))
    return joins.calendar("1995-01-01", "2001-12-31", t.spark, HOLIDAYS).join(per_day, "date", "left").fillna(0, ["orders"])
