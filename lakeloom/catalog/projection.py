"""Projection, filter and conditional logic (2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import conditional as C
from lakeloom.functions.literals import ntz
from lakeloom.registry import query


@query("prj_01_projection", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders
""")
def projection(t):
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
    )


@query("prj_02_sargable_date_range", """
SELECT o_orderkey, o_orderdate::VARCHAR AS order_ts, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
""")
def sargable(t):
    inside = (F.col("o_orderdate") >= ntz("1997-01-01")) & (F.col("o_orderdate") < ntz("1998-01-01"))
    return t.orders.filter(inside).select("o_orderkey", F.col("o_orderdate").alias("order_ts"), "o_totalprice")


@query("prj_03_threshold_bands", """
SELECT event_id, CASE WHEN value < 10 THEN 'zap' WHEN value < 50 THEN 'short'
 WHEN value < 150 THEN 'medium' ELSE 'long' END AS band FROM events
""")
def bands(t):
    band = C.band_below(F.col("value"), [(10, "zap"), (50, "short"), (150, "medium")], "long")
    return t.events.select("event_id", band.alias("band"))


@query("prj_04_standardize_codes", """
SELECT CASE WHEN upper(trim(event_type)) IN ('ERROR','ERR') THEN 'ERROR'
 WHEN upper(trim(event_type)) IN ('VIEW','CLICK') THEN 'INFO'
 WHEN upper(trim(event_type)) IN ('PURCHASE') THEN 'SALE' ELSE 'UNKNOWN' END AS code,
 count(*) AS n FROM events GROUP BY 1
""")
def standardized(t):
    codes = {"ERROR": ["ERROR", "ERR"], "INFO": ["VIEW", "CLICK"], "SALE": ["PURCHASE"]}
    code = C.standardize(F.concat(F.lit(" "), "event_type", F.lit(" ")), codes)
    return t.events.groupBy(code.alias("code")).agg(F.count("*").alias("n"))


@query("prj_05_keyword_category", """
SELECT p_partkey, CASE WHEN contains(upper(p_name),'RING') OR contains(upper(p_name),'BOLT') THEN 'fastener'
 WHEN contains(upper(p_name),'WIDGET') OR contains(upper(p_name),'GEAR') THEN 'device'
 WHEN contains(upper(p_name),'RED') THEN 'red' ELSE 'other' END AS category FROM part
""")
def keywords(t):
    rules = [("fastener", ["RING", "BOLT"]), ("device", ["WIDGET", "GEAR"]), ("red", ["RED"])]
    return t.part.select("p_partkey", C.keyword_category(F.col("p_name"), rules, "other").alias("category"))


@query("prj_06_blank_to_default", """
SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN '  ' ELSE source END), ''), 'unknown') AS source
FROM documents
""")
def blanks(t):
    raw = F.when(F.col("doc_id") % 3 == 0, F.lit("  ")).otherwise(F.col("source"))
    return t.documents.select("doc_id", C.blank_to(raw, "unknown").alias("source"))


@query("prj_07_clip_and_null_range", """
SELECT event_id, greatest(0, least(100, value)) AS clipped,
 CASE WHEN value BETWEEN 5 AND 95 THEN value END AS in_range FROM events
""")
def clipped(t):
    v = F.col("value")
    return t.events.select("event_id", C.clip(v, 0, 100).alias("clipped"), C.null_outside(v, 5, 95).alias("in_range"))


@query("prj_08_sign_correction", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN -c_acctbal ELSE c_acctbal END AS corrected FROM customer
""")
def sign(t):
    return t.customer.select("c_custkey", C.as_negative(F.col("c_acctbal")).alias("corrected"))


@query("prj_09_drop_columns", """
SELECT * EXCLUDE (props, value) REPLACE (ts::VARCHAR AS ts) FROM events
""")
def dropped(t):
    return t.events.drop("props", "value")


@query("prj_10_flag_array", """
SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',',
 CASE WHEN l_discount >= 0.08 THEN 'deep_discount' END,
 CASE WHEN l_quantity >= 45 THEN 'bulk' END,
 CASE WHEN l_returnflag = 'R' THEN 'returned' END) AS risk_factors FROM lineitem
""")
def flag_array(t):
    rules = {
        "deep_discount": F.col("l_discount") >= 0.08,
        "bulk": F.col("l_quantity") >= 45,
        "returned": F.col("l_returnflag") == "R",
    }
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", C.flags(rules).alias("risk_factors"))


@query("prj_11_score_and_grade", """
WITH s AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1),
 p AS (SELECT *, greatest(0, least(100, 100 - failed * 10 - urgent * 5)) AS score FROM s)
SELECT o_custkey, failed, urgent, score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 70 THEN 'B'
 WHEN score >= 50 THEN 'C' WHEN score >= 30 THEN 'D' ELSE 'F' END AS grade FROM p
""")
def scored(t):
    per = t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("failed"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    per = per.withColumn("score", C.penalty_score([F.col("failed") * 10, F.col("urgent") * 5]))
    grades = [(90, "A"), (70, "B"), (50, "C"), (30, "D")]
    return per.withColumn("grade", C.band_from(F.col("score"), grades, "F"))


@query("prj_12_staged_query", """
WITH monthly AS (SELECT date_trunc('month', o_orderdate) AS m, o_custkey, sum(o_totalprice) AS spent
  FROM orders GROUP BY 1, 2),
 big AS (SELECT m, count(*) AS buyers, sum(spent) AS revenue FROM monthly WHERE spent > 100000 GROUP BY 1)
SELECT strftime(m, '%Y-%m') AS month, buyers, round(revenue, 2) AS revenue FROM big
""")
def staged(t):
    monthly = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_custkey").agg(
        F.sum("o_totalprice").alias("spent")
    )
    return (
        monthly.filter("spent > 100000")
        .groupBy("month")
        .agg(F.count("*").alias("buyers"), F.round(F.sum("spent"), 2).alias("revenue"))
    )


@query("prj_13_pipe_syntax", """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_totalprice > 1000 GROUP BY 1
""")
def pipe(t):
    t.views("orders")
    return t.spark.sql(
        "FROM orders |> WHERE o_totalprice > 1000"
        " |> AGGREGATE count(*) AS n, round(sum(o_totalprice), 2) AS total GROUP BY o_orderpriority"
    )


@query("prj_14_exists_mapping", """
SELECT c_custkey, c_name FROM customer c WHERE EXISTS
 (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey AND n.n_regionkey IN (1, 3))
""")
def exists(t):
    allowed = t.nation.filter(F.col("n_regionkey").isin(1, 3))
    return t.customer.join(allowed, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select(
        "c_custkey", "c_name"
    )


@query("prj_15_scalar_as_variable", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM orders)
""")
def scalar_variable(t):
    limit = t.orders.agg(F.avg("o_totalprice") * 1.5)
    return t.orders.filter(F.col("o_totalprice") > limit.scalar()).select("o_orderkey", "o_totalprice")
