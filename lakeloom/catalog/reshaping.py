"""Pivot and unpivot (2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalog._sql import emean, hu
from lakeloom.functions.literals import exact_mean, half_up
from lakeloom.operators import reshape as R
from lakeloom.registry import query

PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}
TYPES = ["view", "click", "purchase", "signup", "error"]


def _case(agg: str, col: str, values: dict, name=lambda label: label) -> str:
    return ", ".join(f"{agg}(CASE WHEN {col} = '{v}' THEN o_totalprice END) AS {name(label)}" for v, label in values.items())


def _month(t):
    return t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))


@query("pvt_01_single", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END), 2) AS urgent,
 round(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END), 2) AS high,
 round(sum(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END), 2) AS low FROM orders GROUP BY 1
""")
def single(t):
    return R.pivot(_month(t), ["month"], "o_orderpriority", PRIORITIES, {"total": F.round(F.sum("o_totalprice"), 2)})


@query("pvt_02_several_aggregates", """
SELECT o_orderstatus, round(sum(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT'), 2) AS urgent_total,
 count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent_cnt,
 round(sum(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW'), 2) AS low_total,
 count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low_cnt FROM orders GROUP BY 1
""")
def several(t):
    keep = {k: PRIORITIES[k] for k in ("1-URGENT", "5-LOW")}
    aggs = {"total": F.round(F.sum("o_totalprice"), 2), "cnt": F.count("*")}
    return R.pivot(t.orders, ["o_orderstatus"], "o_orderpriority", keep, aggs)


@query("pvt_03_dynamic", """
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'error') AS error,
 count(*) FILTER (WHERE event_type = 'purchase') AS purchase, count(*) FILTER (WHERE event_type = 'signup') AS signup,
 count(*) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY 1
""")
def dynamic(t):
    return R.pivot_dynamic(t.events, ["user_id"], "event_type", F.count(F.lit(1))).fillna(0)


@query("pvt_04_pre_aggregated", """
SELECT year(l_shipdate) AS year, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS a,
 sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS n, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS r
FROM lineitem GROUP BY 1
""")
def pre_aggregated(t):
    small = t.lineitem.groupBy(F.year("l_shipdate").cast("bigint").alias("year"), "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    wide = small.groupBy("year").pivot("l_returnflag", ["A", "N", "R"]).agg(F.first("q"))
    return wide.toDF("year", "a", "n", "r")


@query("pvt_05_manual_crosstab", """
SELECT o_orderstatus, count(*) FILTER (WHERE year(o_orderdate) = 1996) AS y1996,
 count(*) FILTER (WHERE year(o_orderdate) = 1997) AS y1997, count(*) AS total FROM orders GROUP BY 1
""")
def crosstab(t):
    y = F.year("o_orderdate")
    return t.orders.groupBy("o_orderstatus").agg(
        F.count_if(y == 1996).alias("y1996"), F.count_if(y == 1997).alias("y1997"), F.count("*").alias("total"))


QUARTERS_SQL = """
q AS (SELECT year(o_orderdate) AS year, o_custkey AS cust, round(sum(o_totalprice) FILTER (WHERE quarter(o_orderdate) = 1), 2) AS q1,
 round(sum(o_totalprice) FILTER (WHERE quarter(o_orderdate) = 2), 2) AS q2, round(sum(o_totalprice) FILTER (WHERE quarter(o_orderdate) = 3), 2) AS q3,
 round(sum(o_totalprice) FILTER (WHERE quarter(o_orderdate) = 4), 2) AS q4 FROM orders GROUP BY ALL)
"""
LONG_SQL = " UNION ALL ".join(f"SELECT year, cust, '{q}' AS quarter, {q} AS sales FROM q" for q in ("q1", "q2", "q3", "q4"))


def _quarters(t):
    q = F.quarter("o_orderdate")
    return t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("year"), F.col("o_custkey").alias("cust")).agg(
        *[F.round(F.sum(F.when(q == i, F.col("o_totalprice"))), 2).alias(f"q{i}") for i in (1, 2, 3, 4)])


@query("pvt_06_unpivot", f"WITH {QUARTERS_SQL} SELECT * FROM ({LONG_SQL}) WHERE sales IS NOT NULL")
def unpivoted(t):
    return R.unpivot(_quarters(t), ["year", "cust"], ["q1", "q2", "q3", "q4"], "quarter", "sales")


@query("pvt_07_unpivot_with_nulls", f"WITH {QUARTERS_SQL} {LONG_SQL}")
def unpivoted_nulls(t):
    return R.unpivot(_quarters(t), ["year", "cust"], ["q1", "q2", "q3", "q4"], "quarter", "sales", keep_nulls=True)


@query("pvt_08_entity_attribute_value", """
SELECT p_partkey, 'p_brand' AS attribute, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
UNION ALL SELECT p_partkey, 'p_size', p_size::VARCHAR FROM part
""")
def eav(t):
    return R.attributes(t.part, "p_partkey", ["p_brand", "p_type", "p_size"])


@query("pvt_09_year_over_year", """
WITH s AS (SELECT o_custkey, round(sum(o_totalprice) FILTER (WHERE year(o_orderdate) = 1996), 2) AS prev,
 round(sum(o_totalprice) FILTER (WHERE year(o_orderdate) = 1997), 2) AS cur FROM orders GROUP BY 1)
SELECT o_custkey, coalesce(prev, 0) AS prev, coalesce(cur, 0) AS cur, CASE WHEN coalesce(prev, 0) = 0 THEN 'N/A'
 ELSE (floor((coalesce(cur, 0) - prev) / prev * 1000 + 0.5)::BIGINT)::VARCHAR END AS growth_permille FROM s
""")
def year_over_year(t):
    y = F.year("o_orderdate")
    s = t.orders.groupBy("o_custkey").agg(
        *[F.coalesce(F.round(F.sum(F.when(y == v, F.col("o_totalprice"))), 2), F.lit(0.0)).alias(n)
          for v, n in ((1996, "prev"), (1997, "cur"))])
    growth = F.floor((F.col("cur") - F.col("prev")) / F.nullif("prev", F.lit(0.0)) * 1000 + 0.5)
    return s.withColumn("growth_permille", F.coalesce(growth.cast("string"), F.lit("N/A")))


@query("pvt_10_hour_weekday_heat_map", "SELECT hour(ts) AS hour, " + ", ".join(
    f"count(*) FILTER (WHERE dayofweek(ts) + 1 = {d}) AS d{d}" for d in range(1, 8)) + " FROM events GROUP BY 1")
def heat_map(t):
    base = t.events.select(F.hour("ts").cast("bigint").alias("hour"), F.dayofweek("ts").alias("dow"))
    return R.pivot(base, ["hour"], "dow", {d: f"d{d}" for d in range(1, 8)}, {"n": F.count("*")}).fillna(0)


@query("pvt_11_event_count_matrix", "SELECT user_id, " + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{e}') AS n_{e}" for e in TYPES) + " FROM events GROUP BY 1")
def matrix(t):
    return R.pivot(t.events, ["user_id"], "event_type", {e: f"n_{e}" for e in TYPES}, {"n": F.count("*")}).fillna(0)


@query("pvt_12_sensor_columns", "SELECT date_trunc('hour', ts)::VARCHAR AS hour, " + ", ".join(
    f"{hu(emean('value', 2, f'''event_type = '{e}' '''), 4)} AS {e}" for e in ("view", "click", "error")) + " FROM events GROUP BY 1")
def sensors(t):
    base = t.events.withColumn("hour", F.date_trunc("hour", "ts"))
    return R.pivot(base, ["hour"], "event_type", {e: e for e in ("view", "click", "error")}, {"v": half_up(exact_mean("value"), 4)})
