"""Data quality (2.10). Orders with planted violations stand in for a raw feed."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.catalog._sql import hu
from lakeloom.functions.literals import half_up, ntz
from lakeloom.operators import quality as Q
from lakeloom.registry import query

RAW_SQL = """
raw AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_orderdate AS order_date,
 CASE WHEN o_orderkey % 11 = 3 THEN -o_totalprice WHEN o_orderkey % 13 = 5 THEN NULL ELSE o_totalprice END AS amount,
 CASE WHEN o_orderkey % 7 = 2 THEN 'user' || o_custkey ELSE 'user' || o_custkey || '@example.com' END AS email,
 (o_orderkey * 37) % 60 AS discount_pct FROM orders)
"""


def raw_orders(t):
    key = F.col("o_orderkey")
    name = F.concat(F.lit("user"), F.col("o_custkey").cast("string"))
    return t.orders.select(
        key.alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("order_date"),
        F.when(key % 11 == 3, -F.col("o_totalprice")).when(key % 13 == 5, None).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(key % 7 == 2, name).otherwise(F.concat(name, F.lit("@example.com"))).alias("email"),
        ((key * 37) % 60).alias("discount_pct"))


RULES = {"positive_amount": "amount > 0", "known_status": "status IN ('O', 'F', 'P')", "valid_email": "email LIKE '%@%'"}
BAD_AMOUNT, BAD_MAIL = "NOT coalesce(amount > 0, false)", "NOT coalesce(email LIKE '%@%', false)"


@query("dq_01_expect_warn", f"""
WITH {RAW_SQL} SELECT 'positive_amount' AS rule, count(*) FILTER (WHERE NOT ({BAD_AMOUNT})) AS passed,
 count(*) FILTER (WHERE {BAD_AMOUNT}) AS failed FROM raw
UNION ALL SELECT 'known_status', count(*) FILTER (WHERE status IN ('O','F','P')), count(*) FILTER (WHERE status NOT IN ('O','F','P')) FROM raw
UNION ALL SELECT 'valid_email', count(*) FILTER (WHERE NOT ({BAD_MAIL})), count(*) FILTER (WHERE {BAD_MAIL}) FROM raw
""")
def warn(t):
    return Q.report(raw_orders(t), Q.parse(RULES))


@query("dq_02_expect_or_drop", f"WITH {RAW_SQL} SELECT order_id, amount FROM raw WHERE amount > 0")
def drop(t):
    return Q.drop_bad(raw_orders(t), Q.parse({"positive_amount": "amount > 0"})).select("order_id", "amount")


@query("dq_03_expect_or_fail", "SELECT o_orderkey, o_totalprice FROM orders")
def fail(t):
    return Q.fail_on_bad(t.orders, {"priced": F.col("o_totalprice") > 0}).select("o_orderkey", "o_totalprice")


@query("dq_04_rule_dictionary", f"""
WITH {RAW_SQL} SELECT order_id, email, amount FROM raw WHERE NOT ({BAD_AMOUNT}) AND NOT ({BAD_MAIL}) AND status IN ('O','F','P')
""")
def dictionary(t):
    return Q.drop_bad(raw_orders(t), Q.parse(RULES)).select("order_id", "email", "amount")


@query("dq_05_compound_rules", f"""
WITH {RAW_SQL} SELECT status, count(*) AS n, count(*) FILTER (WHERE coalesce(CASE status WHEN 'F' THEN discount_pct <= 50
 WHEN 'O' THEN discount_pct <= 30 ELSE discount_pct <= 20 END, false)) AS ok FROM raw GROUP BY 1
""")
def compound(t):
    cap = F.when(F.col("status") == "F", 50).when(F.col("status") == "O", 30).otherwise(20)
    ok = Q.all_hold({"cap": F.col("discount_pct") <= cap})
    return raw_orders(t).groupBy("status").agg(F.count("*").alias("n"), F.count_if(ok).alias("ok"))


@query("dq_06_quarantine", f"""
WITH {RAW_SQL} SELECT order_id, concat_ws(',', CASE WHEN {BAD_AMOUNT} THEN 'positive_amount' END,
 CASE WHEN {BAD_MAIL} THEN 'valid_email' END) AS violated_rules,
 CASE WHEN {BAD_AMOUNT} THEN 'positive_amount' ELSE 'valid_email' END AS first_rule, '2024-01-01 00:00:00' AS quarantined_at
FROM raw WHERE {BAD_AMOUNT} OR {BAD_MAIL}
""")
def quarantined(t):
    _, bad = Q.quarantine(raw_orders(t), Q.parse(RULES), ntz("2024-01-01"))
    return bad.select("order_id", "violated_rules", "first_rule", "quarantined_at")


@query("dq_07_rules_in_a_table", f"WITH {RAW_SQL} SELECT order_id FROM raw WHERE amount > 1000 AND email LIKE '%@%'")
def rule_table(t):
    rows = [("big_enough", "amount > 1000", "orders", True), ("mail", "email LIKE '%@%'", "orders", True),
            ("off", "amount > 1e9", "orders", False), ("other", "value > 0", "events", True)]
    rules = t.spark.createDataFrame(rows, "rule_name string, rule_expression string, target_table string, is_active boolean")
    return Q.drop_bad(raw_orders(t), Q.rules_for(rules, "orders")).select("order_id")


@query("dq_08_quality_log_summary", f"""
WITH {RAW_SQL}, d AS (SELECT order_date::DATE AS day, count(*) AS n, count(*) FILTER (WHERE {BAD_AMOUNT}) AS fa,
  count(*) FILTER (WHERE {BAD_MAIL}) AS fm FROM raw GROUP BY 1),
 l AS (SELECT day, 'positive_amount' AS name, n - fa AS passed, fa AS failed FROM d UNION ALL SELECT day, 'valid_email', n - fm, fm FROM d)
SELECT strftime(day, '%Y-%m') AS month, name, sum(passed)::BIGINT AS passed, sum(failed)::BIGINT AS failed,
 {hu("sum(failed) * 100.0 / (sum(passed) + sum(failed))", 4)} AS failure_pct FROM l GROUP BY ALL
""")
def log_summary(t):
    rules = Q.parse({k: RULES[k] for k in ("positive_amount", "valid_email")})
    daily = raw_orders(t).groupBy(F.to_date("order_date").alias("day")).agg(
        F.count("*").alias("n"), *[F.count_if(~Q.holds(c)).alias(k) for k, c in rules.items()])
    # one event-log record per day, as a JSON list of expectation results
    results = F.to_json(F.array(*[
        F.struct(F.lit(k).alias("name"), (F.col("n") - F.col(k)).alias("passed"), F.col(k).alias("failed")) for k in rules]))
    log = daily.select("day", results.alias("details"))
    parsed = F.from_json("details", "array<struct<name:string,passed:bigint,failed:bigint>>")
    rows = log.select(F.date_format("day", "yyyy-MM").alias("month"), F.explode(parsed).alias("e")).select("month", "e.*")
    total = F.sum("passed") + F.sum("failed")
    return rows.groupBy("month", "name").agg(
        F.sum("passed").alias("passed"), F.sum("failed").alias("failed"),
        half_up(F.sum("failed") * 100.0 / total, 4).alias("failure_pct"))


@query("dq_09_null_duplicate_negative", f"""
WITH {RAW_SQL} SELECT count(*) AS total, count(*) FILTER (WHERE amount IS NULL) AS nulls,
 count(*) FILTER (WHERE amount < 0) AS negatives,
 (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM raw GROUP BY customer_id)) AS duplicates FROM raw
""")
def null_dup_neg(t):
    return Q.null_duplicate_negative(raw_orders(t), "customer_id", "amount", "amount")


@query("dq_10_physical_ranges", """
SELECT 'l_quantity' AS "column", count(*) FILTER (WHERE NOT coalesce(l_quantity BETWEEN 2 AND 49, false)) AS out_of_range FROM lineitem
UNION ALL SELECT 'l_discount', count(*) FILTER (WHERE NOT coalesce(l_discount BETWEEN 0 AND 0.05, false)) FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE NOT coalesce(l_tax BETWEEN 0 AND 1, false)) FROM lineitem
""")
def ranges(t):
    return Q.out_of_range(t.lineitem, {"l_quantity": (2, 49), "l_discount": (0, 0.05), "l_tax": (0, 1)})


@query("dq_11_orphans", """
SELECT event_id, user_id FROM events WHERE NOT EXISTS
 (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_mktsegment <> 'BUILDING')
""")
def orphans(t):
    parents = t.customer.filter("c_mktsegment <> 'BUILDING'")
    return t.events.join(parents, F.col("user_id") == F.col("c_custkey"), "left_anti").select("event_id", "user_id")


@query("dq_12_freshness", """
SELECT event_type, max(ts)::VARCHAR AS last_change, (epoch(TIMESTAMP '2024-02-01')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT) // 3600 AS hours,
 (epoch(TIMESTAMP '2024-02-01')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT) // 3600 > 24 AS stale FROM events GROUP BY 1
""")
def fresh(t):
    return Q.freshness(t.events, "ts", ntz("2024-02-01"), 24, ["event_type"])


@query("dq_13_volume_gate", """
SELECT event_type, count(*) AS n, CASE WHEN count(*) = 0 THEN 'empty' WHEN count(*) < 2000 THEN 'low' ELSE 'normal' END AS volume
FROM events GROUP BY 1
""")
def gate(t):
    return Q.volume(t.events, 2000, ["event_type"])
