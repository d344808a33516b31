"""Scalar functions (2.8) and the function surface (2.20)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.catalog._sql import hu
from lakeloom.functions.literals import half_up
from lakeloom.registry import query


@query("scl_01_string", """
SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_name) AS low, trim('  ' || c_name || ' ') AS trimmed,
 concat_ws('-', c_mktsegment, c_nationkey::VARCHAR) AS joined, left(c_name, 4) AS l4, right(c_name, 3) AS r3,
 substr(c_name, 3, 5) AS mid, replace(c_name, '#', '_') AS repl, length(c_name) AS len, instr(c_name, '#') AS pos,
 split_part(c_name, '#', 2) AS num, regexp_replace(c_name, '[0-9]', 'x', 'g') AS masked,
 regexp_matches(c_name, '00[1-3]$') AS rl, c_mktsegment LIKE 'B%' AS lk, lpad(c_nationkey::VARCHAR, 4, '0') AS padded
FROM customer
""")
def strings(t):
    name = F.col("c_name")
    nation = F.col("c_nationkey").cast("string")
    return t.customer.select(
        "c_custkey", F.upper("c_mktsegment").alias("up"), F.lower(name).alias("low"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.concat_ws("-", "c_mktsegment", nation).alias("joined"), F.left(name, F.lit(4)).alias("l4"),
        F.right(name, F.lit(3)).alias("r3"), F.substring(name, 3, 5).alias("mid"),
        F.replace(name, F.lit("#"), F.lit("_")).alias("repl"), F.length(name).cast("bigint").alias("len"),
        F.instr(name, "#").cast("bigint").alias("pos"), F.split_part(name, F.lit("#"), F.lit(2)).alias("num"),
        F.regexp_replace(name, "[0-9]", "x").alias("masked"), name.rlike("00[1-3]$").alias("rl"),
        F.col("c_mktsegment").like("B%").alias("lk"), F.lpad(nation, 4, "0").alias("padded"))


@query("scl_02_date_time", """
SELECT event_id, date_trunc('hour', ts)::VARCHAR AS hour_start, strftime(ts, '%Y/%m/%d %H:%M') AS shown, year(ts) AS y,
 month(ts) AS m, hour(ts) AS h, dayofweek(ts) + 1 AS dow, quarter(ts) AS q,
 date_diff('day', DATE '2024-01-01', ts::DATE) AS days, (ts::DATE + 7)::VARCHAR AS plus7, (ts::DATE - 3)::VARCHAR AS minus3,
 (ts::DATE + INTERVAL 1 MONTH)::DATE::VARCHAR AS next_month, epoch(date_trunc('second', ts))::BIGINT AS unix_s,
 epoch_us(ts) // 1000 AS unix_ms, (date_trunc('second', ts) + INTERVAL 90 MINUTE)::VARCHAR AS later,
 date_diff('minute', TIMESTAMP '2024-01-01', date_trunc('minute', ts)) AS minutes FROM events
""")
def dates(t):
    ts = F.col("ts")
    day = F.to_date(ts)
    utc = ts.cast("timestamp")
    return t.events.select(
        "event_id", F.date_trunc("hour", ts).alias("hour_start"), F.date_format(ts, "yyyy/MM/dd HH:mm").alias("shown"),
        F.year(ts).cast("bigint").alias("y"), F.month(ts).cast("bigint").alias("m"), F.hour(ts).cast("bigint").alias("h"),
        F.dayofweek(ts).cast("bigint").alias("dow"), F.quarter(ts).cast("bigint").alias("q"),
        F.datediff(day, F.lit("2024-01-01").cast("date")).cast("bigint").alias("days"), F.date_add(day, 7).alias("plus7"),
        F.date_sub(day, 3).alias("minus3"), F.add_months(day, 1).alias("next_month"),
        F.unix_seconds(utc).alias("unix_s"), F.unix_millis(utc).alias("unix_ms"),
        F.timestamp_add("MINUTE", F.lit(90), F.date_trunc("second", ts)).alias("later"),
        F.timestamp_diff("MINUTE", F.lit("2024-01-01").cast("timestamp"), F.date_trunc("minute", ts)).alias("minutes"))


@query("scl_03_math", f"""
SELECT event_id, {hu("value", 1)} AS r1, floor(value)::BIGINT AS fl, ceil(value)::BIGINT AS ce, abs(value - 50) AS dist,
 greatest(value, 25) AS g, least(value, 75) AS l FROM events
""")
def math(t):
    v = F.col("value")
    return t.events.select(
        "event_id", half_up(v, 1).alias("r1"), F.floor(v).alias("fl"), F.ceil(v).alias("ce"), F.abs(v - 50).alias("dist"),
        F.greatest(v, F.lit(25)).alias("g"), F.least(v, F.lit(75)).alias("l"))


@query("scl_04_null_logic", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status, CASE WHEN o_totalprice > 250000 THEN 'big'
 WHEN o_totalprice > 100000 THEN 'mid' ELSE 'small' END AS size, if(o_custkey % 2 = 0, 'even', 'odd') AS parity,
 o_totalprice / nullif(o_custkey % 5, 0) AS ratio, o_custkey::VARCHAR AS cust_text,
 TRY_CAST(split_part(o_orderpriority, '-', 1) AS INT) AS level FROM orders
""")
def nulls(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("pending")).alias("status"),
        F.when(price > 250000, "big").when(price > 100000, "mid").otherwise("small").alias("size"),
        F.expr("if(o_custkey % 2 = 0, 'even', 'odd')").alias("parity"),
        F.try_divide(price, F.nullif(F.col("o_custkey") % 5, F.lit(0))).alias("ratio"),
        F.col("o_custkey").cast("string").alias("cust_text"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).try_cast("int").alias("level"))


@query("scl_05_array", """
SELECT c_custkey, len(list_value(c_mktsegment, c_name)) AS size, c_name AS second, u.v AS step
FROM customer, unnest(range(0, c_nationkey % 4 + 1)) AS u(v)
""")
def arrays(t):
    pair = F.array("c_mktsegment", F.when(F.lit(False), "x"), "c_name")
    steps = F.sequence(F.lit(0).cast("bigint"), (F.col("c_nationkey") % 4).cast("bigint"))
    return t.customer.select(
        "c_custkey", F.size(F.array_compact(pair)).cast("bigint").alias("size"),
        F.element_at(F.array_compact(pair), 2).alias("second"), F.explode(steps).alias("step"))


@query("scl_06_map_struct", """
SELECT c_custkey, 'balance,segment' AS keys, c_mktsegment AS segment, c_nationkey AS nation FROM customer
""")
def maps(t):
    m = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("balance"), F.col("c_acctbal").cast("string"))
    s = t.customer.select("c_custkey", m.alias("m"), F.struct(F.col("c_nationkey").alias("nation")).alias("s"))
    return s.select("c_custkey", F.array_sort(F.map_keys("m")).alias("keys"), F.col("m")["segment"].alias("segment"), "s.nation")


@query("scl_07_json_path", """
SELECT event_id, json_extract_string(props, '$.k')::INT AS k, (json_extract_string(props, '$.k')::INT * 2) AS doubled FROM events
""")
def json_path(t):
    v = F.parse_json("props")
    return t.events.select(
        "event_id", F.variant_get(v, "$.k", "int").alias("k"),
        (F.get_json_object("props", "$.k").cast("int") * 2).alias("doubled"))


@query("scl_08_json_parse_explode", """
SELECT event_id, u.name, CASE u.name WHEN 'k' THEN json_extract_string(props, '$.k')::BIGINT ELSE user_id END AS val
FROM events, (VALUES ('k'), ('user')) u(name)
""")
def json_parse(t):
    k = F.get_json_object("props", "$.k")
    text = F.concat(F.lit('[{"name":"k","val":'), k, F.lit('},{"name":"user","val":'), F.col("user_id").cast("string"), F.lit("}]"))
    parsed = F.from_json(text, "array<struct<name:string,val:bigint>>")
    return t.events.select("event_id", F.explode(parsed).alias("i")).select("event_id", "i.name", "i.val")


@query("scl_09_explode_items", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
""")
def explode_items(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("scl_10_hash_key", """
SELECT c_custkey, sha256(lower(trim(c_name))) AS h FROM customer
""")
def hashed(t):
    return t.customer.select("c_custkey", F.sha2(F.lower(F.trim("c_name")), 256).alias("h"))


@query("udf_01_sql_scalar_function", """
SELECT o_orderkey, o_totalprice * 0.9 AS net, CASE WHEN o_totalprice >= 300000 THEN 'VIP' ELSE 'STD' END AS tier FROM orders
""")
def sql_function(t):
    t.views("orders")
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION lakeloom_net(x DOUBLE, rate DOUBLE) RETURNS DOUBLE RETURN x * (1 - rate)")
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION lakeloom_tier(x DOUBLE) RETURNS STRING"
                " RETURN CASE WHEN x >= 300000 THEN 'VIP' ELSE 'STD' END")
    return t.spark.sql(
        "SELECT o_orderkey, lakeloom_net(o_totalprice, 0.1D) AS net, lakeloom_tier(o_totalprice) AS tier FROM orders")


def checksum_digit(number):
    """Weighted-sum check digit of a ten-digit number, in native expressions.

    Fixed values: weights 1 3 7 1 3 7 1 3 5, the last digit is the check digit.
    """
    weights = [1, 3, 7, 1, 3, 7, 1, 3, 5]
    digits = [F.substring(number, i + 1, 1).cast("int") for i in range(9)]
    total = sum((d * w for d, w in zip(digits[1:], weights[1:])), digits[0] * weights[0])
    total = total + F.floor(digits[8] * 5 / 10)
    return (10 - total % 10) % 10


@query("udf_02_checksum_and_json_field", """
WITH n AS (SELECT event_id, lpad(((event_id * 7919 + 104729) % 10000000000)::VARCHAR, 10, '0') AS num, props FROM events),
 s AS (SELECT *, substr(num,1,1)::INT + substr(num,2,1)::INT*3 + substr(num,3,1)::INT*7 + substr(num,4,1)::INT
  + substr(num,5,1)::INT*3 + substr(num,6,1)::INT*7 + substr(num,7,1)::INT + substr(num,8,1)::INT*3 + substr(num,9,1)::INT*5
  + floor(substr(num,9,1)::INT*5/10)::INT AS total FROM n)
SELECT event_id, num, ((10 - total % 10) % 10) = substr(num,10,1)::INT AS valid, json_extract_string(props, '$.k') AS k FROM s
""")
def python_function(t):
    num = F.lpad(((F.col("event_id") * 7919 + 104729) % 10000000000).cast("string"), 10, "0")
    base = t.events.select("event_id", num.alias("num"), F.get_json_object("props", "$.k").alias("k"))
    return base.select("event_id", "num", (checksum_digit(F.col("num")) == F.substring("num", 10, 1).cast("int")).alias("valid"), "k")


@query("udf_03_table_function", """
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1
""")
def table_function(t):
    t.views("orders")
    t.orders.createOrReplaceGlobalTempView("lakeloom_orders")
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION lakeloom_orders_between(a STRING, b STRING)"
        " RETURNS TABLE (status STRING, price DOUBLE) RETURN SELECT o_orderstatus, o_totalprice FROM global_temp.lakeloom_orders"
        " WHERE o_orderdate >= CAST(a AS TIMESTAMP_NTZ) AND o_orderdate < CAST(b AS TIMESTAMP_NTZ)")
    return t.spark.sql(
        "SELECT status AS o_orderstatus, count(*) AS n FROM lakeloom_orders_between('1999-01-01', '2000-01-01') GROUP BY 1")


@query("udf_04_model_as_function", f"""
SELECT event_id, {hu("1 / (1 + exp(-(0.02 * value - 1)))", 6)} AS score FROM events
""")
def model_function(t):
    @F.pandas_udf(T.DoubleType())
    def score(v: pd.Series) -> pd.Series:
        return 1 / (1 + np.exp(-(0.02 * v - 1)))

    return t.events.select("event_id", half_up(score("value"), 6).alias("score"))


@query("udf_04b_trained_model", """
WITH m AS (SELECT regr_slope(o_totalprice, x) AS slope, regr_intercept(o_totalprice, x) AS intercept FROM (SELECT o_totalprice, date_diff('day', DATE '1992-01-01', o_orderdate::DATE) / 100 AS x FROM orders WHERE o_orderkey % 5 <> 0))
SELECT o_orderkey, round(intercept + slope * (date_diff('day', DATE '1992-01-01', o_orderdate::DATE) / 100), 3) AS expected, o_orderkey % 5 = 0 AS held_out FROM orders, m
""")
def trained_model(t):
    """A model trained on four fifths of the rows and applied to all as a transformer, without leaving the JVM."""
    days = F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")) / 100
    rows = t.orders.select("o_orderkey", "o_totalprice", days.alias("days"), (F.col("o_orderkey") % 5 == 0).alias("held_out"))
    rows = VectorAssembler(inputCols=["days"], outputCol="features").transform(rows)
    model = LinearRegression(labelCol="o_totalprice", solver="normal", predictionCol="expected").fit(rows.filter("NOT held_out"))
    return model.transform(rows).select("o_orderkey", F.round("expected", 3).alias("expected"), "held_out")


@query("udf_06_sql_script", """
SELECT o_orderpriority, count(*) AS n, CASE WHEN (SELECT count(*) FROM orders) = 0 THEN 'empty'
 WHEN (SELECT count(*) FROM orders) < 100 THEN 'low' ELSE 'normal' END AS volume FROM orders GROUP BY 1
""")
def script(t):
    t.views("orders")
    return t.spark.sql("""
BEGIN
  DECLARE n BIGINT;
  DECLARE volume STRING DEFAULT 'normal';
  SET n = (SELECT count(*) FROM orders);
  IF n = 0 THEN SET volume = 'empty'; ELSEIF n < 100 THEN SET volume = 'low'; END IF;
  EXECUTE IMMEDIATE 'SELECT o_orderpriority, count(*) AS n, ? AS volume FROM orders GROUP BY 1' USING volume;
END
""")
