"""Window functions (2.5).

Raw rows are windowed through ``plans.ordered``; calendar tables (one row per key and day or month)
are small whatever the input size and use plain windows.
"""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.catalog._sql import emean, hu
from lakeloom.functions.literals import exact_mean, half_up
from lakeloom.plans import ordered, skew
from lakeloom.registry import query

DAILY_SQL = """
daily AS (SELECT event_type, ts::DATE AS day, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL)
"""
MONTH_SQL = """
monthly AS (SELECT c_mktsegment AS seg, date_trunc('month', o_orderdate)::DATE AS m, sum(o_totalprice) AS rev
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
"""


def daily(t):
    return t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.sum("value").alias("total"))


def monthly(t):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("seg"), F.trunc("o_orderdate", "month").alias("m"))
        .agg(F.sum("o_totalprice").alias("rev")))


@query("win_01_ranks", """
SELECT s_nationkey, s_suppkey, s_acctbal,
 row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS row_number,
 rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
 ntile(4) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS ntile
FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal DESC)
""")
def ranks(t):
    return ordered.ranks(t.supplier.select("s_nationkey", "s_suppkey", "s_acctbal"), ["s_nationkey"], "s_acctbal", "s_suppkey")


@query("win_02_top_n_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
FROM orders QUALIFY rn <= 3
""")
def top_n(t):
    cols = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return skew.top_per_key(cols, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("win_03_share_of_total", """
SELECT o_orderpriority, round(sum(o_totalprice), 2) AS s, round(s * 100 / sum(s) OVER (), 4) AS share FROM orders GROUP BY 1
""")
def share(t):
    per = t.orders.groupBy("o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("s"))
    return per.withColumn("share", F.round(F.col("s") * 100 / per.agg(F.sum("s")).scalar(), 4))


@query("win_04_difference_from_average", f"""
WITH m AS (SELECT date_trunc('month', o_orderdate) AS m, {emean("o_totalprice")} AS mean FROM orders GROUP BY 1)
SELECT o_orderkey, {hu("o_totalprice - mean", 4)} AS diff FROM orders JOIN m ON m = date_trunc('month', o_orderdate)
""")
def from_average(t):
    base = t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("m"))
    means = base.groupBy("m").agg(exact_mean("o_totalprice").alias("mean"))
    return base.join(means, "m").select("o_orderkey", half_up(F.col("o_totalprice") - F.col("mean"), 4).alias("diff"))


@query("win_05_running_total", """
SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
 ROWS UNBOUNDED PRECEDING), 4) AS running FROM events
""")
def running(t):
    out = ordered.scan(t.events, ["user_id"], ["ts", "event_id"], sums={"running": F.col("value")})
    return out.select("event_id", "user_id", F.round("running", 4).alias("running"))


@query("win_06_moving_average", f"""
WITH {DAILY_SQL} SELECT event_type, day::VARCHAR AS day, n,
 round(avg(n) OVER (PARTITION BY event_type ORDER BY day ROWS 6 PRECEDING), 4) AS ma7,
 (sum(n) OVER (PARTITION BY event_type ORDER BY day ROWS 29 PRECEDING))::BIGINT AS sum30 FROM daily
""")
def moving(t):
    w = W.partitionBy("event_type").orderBy("day")
    return daily(t).select(
        "event_type", "day", "n", F.round(F.avg("n").over(w.rowsBetween(-6, 0)), 4).alias("ma7"),
        F.sum("n").over(w.rowsBetween(-29, 0)).alias("sum30"))


@query("win_07_calendar_frame", f"""
WITH {DAILY_SQL} SELECT event_type, day::VARCHAR AS day, (sum(n) OVER (PARTITION BY event_type ORDER BY day
 RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW))::BIGINT AS n8 FROM daily
""")
def calendar_frame(t):
    daily(t).createOrReplaceTempView("lakeloom_daily")
    return t.spark.sql(
        "SELECT event_type, day, sum(n) OVER (PARTITION BY event_type ORDER BY day"
        " RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS n8 FROM lakeloom_daily")


@query("win_08_lag_lead", f"""
WITH {DAILY_SQL} SELECT event_type, day::VARCHAR AS day, n, lag(n, 1, 0) OVER w AS prev, lead(n, 1, 0) OVER w AS next,
 lag(n, 7) OVER w AS last_week FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY day)
""")
def lag_lead(t):
    w = W.partitionBy("event_type").orderBy("day")
    return daily(t).select(
        "event_type", "day", "n", F.lag("n", 1, 0).over(w).alias("prev"), F.lead("n", 1, 0).over(w).alias("next"),
        F.lag("n", 7).over(w).alias("last_week"))


@query("win_09_growth", f"""
WITH {MONTH_SQL} SELECT seg, strftime(m, '%Y-%m') AS month, round(rev, 2) AS rev,
 round((rev - lag(rev) OVER w) / nullif(lag(rev) OVER w, 0) * 100, 4) AS growth
FROM monthly WINDOW w AS (PARTITION BY seg ORDER BY m)
""")
def growth(t):
    prev = F.lag("rev").over(W.partitionBy("seg").orderBy("m"))
    return monthly(t).select(
        "seg", F.date_format("m", "yyyy-MM").alias("month"), F.round("rev", 2).alias("rev"),
        F.round(F.try_divide(F.col("rev") - prev, prev) * 100, 4).alias("growth"))


@query("win_10_first_last", """
SELECT s_nationkey, s_suppkey, first_value(s_name) OVER w AS top_name, last_value(s_name) OVER w AS bottom_name
FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey
 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")
def first_last(t):
    order = F.struct(-F.col("s_acctbal"), F.col("s_suppkey"))
    ends = t.supplier.groupBy("s_nationkey").agg(
        F.min_by("s_name", order).alias("top_name"), F.max_by("s_name", order).alias("bottom_name"))
    return t.supplier.select("s_nationkey", "s_suppkey").join(ends, "s_nationkey")


@query("win_11_market_share", f"""
WITH {MONTH_SQL} SELECT seg, strftime(m, '%Y-%m') AS month, round(rev * 100 / sum(rev) OVER (PARTITION BY m), 4) AS share,
 rank() OVER (PARTITION BY m ORDER BY rev DESC) AS rank,
 round(sum(rev) OVER (PARTITION BY seg ORDER BY m ROWS UNBOUNDED PRECEDING), 2) AS cumulative FROM monthly
""")
def market_share(t):
    month, seg = W.partitionBy("m"), W.partitionBy("seg").orderBy("m")
    return monthly(t).select(
        "seg", F.date_format("m", "yyyy-MM").alias("month"),
        F.round(F.col("rev") * 100 / F.sum("rev").over(month), 4).alias("share"),
        F.rank().over(month.orderBy(F.desc("rev"))).cast("bigint").alias("rank"),
        F.round(F.sum("rev").over(seg.rowsBetween(W.unboundedPreceding, 0)), 2).alias("cumulative"))


@query("win_12_order_gaps", """
SELECT o_custkey, o_orderkey, date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS gap_days FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) QUALIFY gap_days > 90 OR gap_days IS NULL
""")
def gaps(t):
    seen = ordered.scan(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], before={"prev": F.col("o_orderdate")})
    gap = F.datediff("o_orderdate", "prev").cast("bigint")
    return seen.select("o_custkey", "o_orderkey", gap.alias("gap_days")).filter("gap_days > 90 OR gap_days IS NULL")


@query("win_13_event_pairing", """
SELECT event_id, user_id, event_type, CASE WHEN event_type = 'view' AND lead(event_type) OVER w = 'click'
 THEN epoch(date_trunc('second', lead(ts) OVER w))::BIGINT - epoch(date_trunc('second', ts))::BIGINT END AS duration_sec,
 coalesce(event_type = 'view' AND lead(event_type) OVER w = 'click', false) AS paired
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def pairing(t):
    seen = ordered.scan(t.events, ["user_id"], ["ts", "event_id"], after={"next_type": F.col("event_type"), "next_ts": F.col("ts")})
    paired = F.coalesce((F.col("event_type") == "view") & (F.col("next_type") == "click"), F.lit(False))

    def sec(c):
        return F.unix_seconds(F.col(c).cast("timestamp"))

    return seen.select(
        "event_id", "user_id", "event_type", F.when(paired, sec("next_ts") - sec("ts")).alias("duration_sec"),
        paired.alias("paired"))


STEP_SQL = "CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END"


@query("win_14_sequence_check", f"""
WITH s AS (SELECT event_id, user_id, ts, {STEP_SQL} AS step FROM events)
SELECT event_id, step, coalesce(step >= lag(step) OVER (PARTITION BY user_id ORDER BY ts, event_id), true) AS valid FROM s
""")
def sequence(t):
    steps = {"signup": 1, "view": 2, "click": 3, "purchase": 4}
    code = F.coalesce(F.create_map(*[F.lit(x) for kv in steps.items() for x in kv])[F.col("event_type")], F.lit(0))
    base = t.events.select("event_id", "user_id", "ts", code.alias("step"))
    seen = ordered.scan(base, ["user_id"], ["ts", "event_id"], before={"prev": F.col("step")})
    return seen.select("event_id", "step", F.coalesce(F.col("step") >= F.col("prev"), F.lit(True)).alias("valid"))


@query("win_15_state_chain", """
WITH s AS (SELECT event_id, user_id, ts, event_id % 4 AS cur, (event_id + 1) % 4 AS target, event_type <> 'error' AS ok FROM events)
SELECT event_id, row_number() OVER w AS seq, row_number() OVER w = 1 OR coalesce(cur = lag(target) OVER w AND lag(ok) OVER w, false)
 AS consistent FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def chain(t):
    base = t.events.select(
        "event_id", "user_id", "ts", (F.col("event_id") % 4).alias("cur"), ((F.col("event_id") + 1) % 4).alias("target"),
        (F.col("event_type") != "error").alias("ok"))
    seq = ordered.scan(base, ["user_id"], ["ts", "event_id"], before={"prev_target": F.col("target"), "prev_ok": F.col("ok")},
                       sums={"seq": F.lit(1).cast("bigint")})
    linked = F.coalesce((F.col("cur") == F.col("prev_target")) & F.col("prev_ok"), F.lit(False))
    return seq.select("event_id", "seq", ((F.col("seq") == 1) | linked).alias("consistent"))


@query("win_16_dedup_latest", """
SELECT l_orderkey, l_linenumber, max(l_shipdate)::DATE::VARCHAR AS shipped, arg_max(l_partkey, (l_shipdate, l_partkey, l_suppkey)) AS l_partkey
FROM lineitem GROUP BY 1, 2
""")
def dedup(t):
    order = [F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey")]
    return skew.latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"), "l_partkey")


@query("win_17_two_level_dedup", """
WITH a AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1)
SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate::DATE::VARCHAR AS day FROM a
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate::DATE ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) = 1
""")
def two_level(t):
    once = skew.latest_per_key(
        t.lineitem, ["l_orderkey", "l_linenumber"],
        [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")])
    twice = skew.latest_per_key(
        once.withColumn("day", F.to_date("l_shipdate")), ["l_suppkey", "day"],
        [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")])
    return twice.select("l_orderkey", "l_linenumber", "l_suppkey", "day")


@query("win_18_spikes", f"""
WITH {DAILY_SQL}, p AS (SELECT *, lag(total) OVER (PARTITION BY event_type ORDER BY day) AS prev FROM daily)
SELECT event_type, day::VARCHAR AS day, round(total / prev, 4) AS ratio FROM p WHERE total / nullif(prev, 0) > 1.1
""")
def spikes(t):
    prev = F.lag("total").over(W.partitionBy("event_type").orderBy("day"))
    rated = daily(t).withColumn("ratio", F.try_divide("total", prev))
    return rated.filter("ratio > 1.1").select("event_type", "day", F.round("ratio", 4).alias("ratio"))


@query("win_19_previous_attribute", """
SELECT o_custkey, o_orderkey, o_orderpriority, lag(o_orderpriority) OVER w AS previous,
 date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS tenure_days FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def previous(t):
    seen = ordered.scan(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                        before={"previous": F.col("o_orderpriority"), "prev_date": F.col("o_orderdate")})
    return seen.select(
        "o_custkey", "o_orderkey", "o_orderpriority", "previous",
        F.datediff("o_orderdate", "prev_date").cast("bigint").alias("tenure_days"))
