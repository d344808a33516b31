"""Change capture, history and versions (2.11).

Feeds come from ``orders``: the customer is the key, the order key the sequence, one change in 17 a delete.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.literals import ntz
from lakeloom.operators import history as H
from lakeloom.plans import durable, skew
from lakeloom.registry import query
from lakeloom.sources.keyed import KeyedTable
from lakeloom.sources.versions import VersionedTable

FEED_SQL = """
feed AS (SELECT o_custkey AS cust, o_orderkey AS seq, o_orderpriority AS city, o_orderstatus AS status, o_totalprice AS amount,
 CASE WHEN o_orderkey % 17 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS op FROM orders)
"""


def bucket():
    return F.floor(F.col("seq") / 100000)


def feed(t):
    return t.orders.select(
        F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("city"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderkey") % 17 == 0, "DELETE").otherwise("UPSERT").alias("op"))


SOURCE_SQL = """
src AS (SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_custkey % 5 = 0
 UNION ALL SELECT c_custkey + 1000000000, c_name, c_acctbal FROM customer WHERE c_custkey % 7 = 0)
"""


def _target(t):
    return t.customer.select("c_custkey", "c_name", "c_acctbal")


def _source(t):
    new = t.customer.filter("c_custkey % 7 = 0").select((F.col("c_custkey") + 1000000000).alias("c_custkey"), "c_name", "c_acctbal")
    return _target(t).filter("c_custkey % 5 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 100).unionByName(new)


@query("cdc_01_merge_upsert", f"""
WITH {SOURCE_SQL} SELECT coalesce(s.c_custkey, c.c_custkey) AS c_custkey, coalesce(s.c_name, c.c_name) AS c_name,
 round(coalesce(s.c_acctbal, c.c_acctbal), 2) AS c_acctbal FROM customer c FULL JOIN src s ON s.c_custkey = c.c_custkey
""")
def upsert(t):
    """Into a table laid out in ranges of the key: only ranges that the source reaches are read and written."""
    table = KeyedTable(t.spark, durable.scratch_dir(t.spark, "customers"), ["c_custkey"], rows_per_bucket=100_000)
    table.create(_target(t))
    table.merge(_source(t))
    return table.read().withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("cdc_02_conditional_merge", f"""
WITH {FEED_SQL}, t AS (SELECT c_custkey AS cust, 7000::BIGINT AS seq, c_acctbal AS amount FROM customer WHERE c_custkey % 3 <> 0),
 s AS (SELECT cust, max(seq) AS seq, arg_max(amount, seq) AS amount, arg_max(op, seq) AS op FROM feed GROUP BY 1)
SELECT coalesce(t.cust, s.cust) AS cust, CASE WHEN s.cust IS NOT NULL AND (t.cust IS NULL OR s.seq > t.seq) THEN s.seq ELSE t.seq END AS seq,
 CASE WHEN s.cust IS NOT NULL AND (t.cust IS NULL OR s.seq > t.seq) THEN s.amount ELSE t.amount END AS amount
FROM t FULL JOIN s ON t.cust = s.cust WHERE coalesce(s.op, '') <> 'DELETE'
""")
def conditional(t):
    target = t.customer.filter("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("cust"), F.lit(7000).cast("bigint").alias("seq"), F.col("c_acctbal").alias("amount"))
    newest = skew.latest_per_key(feed(t), ["cust"], [F.desc("seq")]).select("cust", "seq", "amount", "op")
    return H.conditional_merge(target, newest, ["cust"], "seq", "op")


@query("cdc_03_update_delete_by_predicate", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN 'CANCELLED' ELSE o_orderstatus END AS status
FROM orders WHERE NOT (o_orderdate < TIMESTAMP '1996-01-01')
""")
def predicates(t):
    status = F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000), "CANCELLED").otherwise(F.col("o_orderstatus"))
    return t.orders.filter(~(F.col("o_orderdate") < ntz("1996-01-01"))).select("o_orderkey", status.alias("status"))


@query("cdc_04_scd_type_1", f"""
WITH {FEED_SQL} SELECT cust, max(seq) AS seq, arg_max(city, seq) AS city, arg_max(amount, seq) AS amount FROM feed GROUP BY 1
""")
def type1(t):
    return H.scd1(feed(t), ["cust"], ["seq"]).select("cust", "seq", "city", "amount")


HIST_SQL = f"""
{FEED_SQL}, hist AS (SELECT cust, city, status, amount, op, seq AS start_at, lead(seq) OVER (PARTITION BY cust ORDER BY seq) AS end_at FROM feed)
"""


@query("cdc_05_scd_type_2", f"WITH {HIST_SQL} SELECT cust, city, status, start_at, end_at FROM hist")
def type2(t):
    return H.scd2(feed(t), ["cust"], ["seq"], bucket()).select("cust", "city", "status", "start_at", "end_at")


TRACKED_SQL = f"""
{FEED_SQL}, p AS (SELECT *, CASE WHEN lag(seq) OVER w IS NULL OR lag(city) OVER w IS DISTINCT FROM city
   OR (lag(op) OVER w = 'DELETE') <> (op = 'DELETE') THEN 1 ELSE 0 END AS s FROM feed WINDOW w AS (PARTITION BY cust ORDER BY seq)),
 g AS (SELECT *, sum(s) OVER (PARTITION BY cust ORDER BY seq ROWS UNBOUNDED PRECEDING) AS ver FROM p),
 v AS (SELECT cust, ver, min(seq) AS start_at, bool_or(op = 'DELETE') AS del, arg_max(city, seq) AS city, arg_max(amount, seq) AS amount FROM g GROUP BY 1, 2),
 e AS (SELECT *, lead(start_at) OVER (PARTITION BY cust ORDER BY ver) AS end_at FROM v)
"""


@query("cdc_06_tracked_columns", f"WITH {TRACKED_SQL} SELECT cust, city, amount, start_at, end_at FROM e WHERE NOT del")
def tracked(t):
    out = H.scd2(feed(t), ["cust"], ["seq"], bucket(), tracked=["city"], op="op")
    return out.select("cust", "city", "amount", "start_at", "end_at")


@query("cdc_07_apply_as_delete", f"""
WITH {HIST_SQL} SELECT 'type1' AS kind, cust, max(start_at) AS start_at, NULL::BIGINT AS end_at FROM hist GROUP BY cust HAVING arg_max(op, start_at) <> 'DELETE'
UNION ALL SELECT 'type2', cust, start_at, end_at FROM hist WHERE op <> 'DELETE'
""")
def deletes(t):
    one = H.scd1(feed(t), ["cust"], ["seq"], op="op")
    two = H.scd2(feed(t), ["cust"], ["seq"], bucket(), op="op")
    return one.select(F.lit("type1").alias("kind"), "cust", F.col("seq").alias("start_at"), F.lit(None).cast("bigint").alias("end_at")).unionByName(
        two.select(F.lit("type2").alias("kind"), "cust", "start_at", "end_at"))


@query("cdc_08_apply_as_truncate", """
WITH f AS (SELECT o_custkey AS cust, o_orderkey AS seq, CASE WHEN o_orderkey % 4001 = 4000 THEN 'TRUNCATE' ELSE 'UPSERT' END AS op FROM orders)
SELECT cust, max(seq) AS seq FROM f WHERE op <> 'TRUNCATE' AND seq > coalesce((SELECT max(seq) FROM f WHERE op = 'TRUNCATE'), -1) GROUP BY 1
""")
def truncate(t):
    changes = feed(t).withColumn("op", F.when(F.col("seq") % 4001 == 4000, "TRUNCATE").otherwise("UPSERT"))
    return H.scd1(H.after_truncate(changes, "seq", "op"), ["cust"], ["seq"]).select("cust", "seq")


@query("cdc_09_envelope", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CASE WHEN o_orderkey % 5 = 0 THEN 'd' ELSE 'u' END AS op,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS amount, epoch_ms(o_orderdate) AS ts_ms FROM orders
""")
def envelope(t):
    image = F.struct(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"))
    gone = F.col("o_orderkey") % 5 == 0
    message = F.struct(F.struct(
        F.when(gone, "d").otherwise("u").alias("op"), image.alias("before"), F.when(~gone, image).alias("after"),
        F.struct(F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms")).alias("source")).alias("payload"))
    raw = t.orders.select(F.to_json(message).alias("value"))
    row = "struct<order_id:bigint,customer_id:bigint,amount:double>"
    schema = f"payload struct<op:string,before:{row},after:{row},source:struct<ts_ms:bigint>>"
    p = raw.select(F.from_json("value", schema).alias("m")).select("m.payload.*")
    # a delete has no after image, so the key comes from whichever image is there
    key = F.coalesce("after", "before")
    return p.select(key["order_id"].alias("order_id"), key["customer_id"].alias("customer_id"), "op",
                    F.col("after.amount").alias("amount"), F.col("source.ts_ms").alias("ts_ms"))


@query("cdc_10_state_as_of", f"WITH {HIST_SQL} SELECT cust, city, start_at FROM hist WHERE op <> 'DELETE' AND start_at <= 9000 AND (end_at > 9000 OR end_at IS NULL)")
def as_of(t):
    return H.state_as_of(H.scd2(feed(t), ["cust"], ["seq"], bucket(), op="op"), F.lit(9000)).select("cust", "city", "start_at")


V_SQL = """
v0 AS (SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer WHERE c_custkey % 10 <> 1),
v1 AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + c_custkey % 300 ELSE c_acctbal END AS balance, c_mktsegment AS segment
 FROM customer WHERE c_custkey % 10 <> 2)
"""


def _snapshots(t):
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    moved = F.when(F.col("id") % 4 == 0, F.col("balance") + F.col("id") % 300).otherwise(F.col("balance"))
    return base.filter("id % 10 <> 1"), base.filter("id % 10 <> 2").withColumn("balance", moved)


@query("cdc_11_change_feed", f"""
WITH {V_SQL}, j AS (SELECT v0.id AS a, v1.id AS b, v0.balance AS ab, v1.balance AS bb, v0.segment AS s0, v1.segment AS s1 FROM v0 FULL JOIN v1 ON v0.id = v1.id)
SELECT b AS id, 'insert' AS _change_type, bb AS balance, s1 AS segment FROM j WHERE a IS NULL
UNION ALL SELECT a, 'delete', ab, s0 FROM j WHERE b IS NULL
UNION ALL SELECT a, 'update_preimage', ab, s0 FROM j WHERE a = b AND (ab, s0) <> (bb, s1)
UNION ALL SELECT a, 'update_postimage', bb, s1 FROM j WHERE a = b AND (ab, s0) <> (bb, s1)
""")
def change_feed(t):
    return H.change_feed(*_snapshots(t), ["id"])


@query("cdc_12_version_compare", f"""
WITH {V_SQL} SELECT id, round(v1.balance - v0.balance, 2) AS change FROM v0 JOIN v1 USING (id) WHERE abs(v1.balance - v0.balance) > 100
""")
def compare(t):
    a, b = _snapshots(t)
    joined = a.select("id", F.col("balance").alias("old")).join(b.select("id", F.col("balance").alias("new")), "id")
    return joined.filter(F.abs(F.col("new") - F.col("old")) > 100).select("id", F.round(F.col("new") - F.col("old"), 2).alias("change"))


def _versioned(t):
    table = VersionedTable(t.spark, durable.scratch_dir(t.spark, "versions"))
    a, b = _snapshots(t)
    table.commit(a, 0, "WRITE", ntz("2024-01-01"))
    table.commit(b, 1, "MERGE", ntz("2024-01-02"))
    table.restore(0, 2, ntz("2024-01-03"))
    return table


@query("cdc_13_time_travel_and_restore", f"""
WITH {V_SQL} SELECT 'by_version' AS how, count(*) AS n, round(sum(balance), 2) AS total FROM v0
UNION ALL SELECT 'by_time', count(*), round(sum(balance), 2) FROM v1 UNION ALL SELECT 'restored', count(*), round(sum(balance), 2) FROM v0
""")
def travel(t):
    table = _versioned(t)

    def shown(df, how):
        return df.agg(F.count("*").alias("n"), F.round(F.sum("balance"), 2).alias("total")).select(F.lit(how).alias("how"), "n", "total")

    return (shown(table.as_of_version(0), "by_version").unionByName(shown(table.as_of_time(ntz("2024-01-02 12:00:00")), "by_time"))
            .unionByName(shown(table.as_of_version(2), "restored")))


@query("cdc_14_version_log", f"""
WITH {V_SQL} SELECT 0::BIGINT AS version, 'WRITE' AS operation, count(*) AS rows, '2024-01-01 00:00:00' AS committed_at FROM v0
UNION ALL SELECT 1, 'MERGE', count(*), '2024-01-02 00:00:00' FROM v1 UNION ALL SELECT 2, 'RESTORE 0', count(*), '2024-01-03 00:00:00' FROM v0
""")
def version_log(t):
    return _versioned(t).log()


@query("cdc_16_history_from_change_feed", f"WITH {HIST_SQL} SELECT cust, city, start_at, end_at, end_at IS NULL AS is_current FROM hist WHERE op <> 'DELETE'")
def from_feed(t):
    kinds = F.when(F.col("op") == "DELETE", F.array(F.lit("delete"))).otherwise(F.array(F.lit("update_preimage"), F.lit("update_postimage")))
    cdf = feed(t).withColumn("_change_type", F.explode(kinds)).drop("op")
    images = cdf.filter("_change_type <> 'update_preimage'")
    out = H.scd2(images, ["cust"], ["seq"], bucket(), op="_change_type", delete="delete")
    return out.select("cust", "city", "start_at", "end_at", F.col("end_at").isNull().alias("is_current"))


@query("cdc_17_incremental_refresh", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def refresh(t):
    """The new orders alone move the stored sums."""
    fresh = F.col("o_orderdate") >= ntz("2001-01-01")
    stored = durable.cut(H.summed(t.orders.filter(~fresh), ["o_custkey"], "o_totalprice"), "stored")
    feed = t.orders.filter(fresh).withColumn("_change_type", F.lit("insert"))
    out = H.refresh_by_deltas(stored, feed, lambda keys: t.orders.join(keys, "o_custkey", "left_semi"), ["o_custkey"], "o_totalprice")
    return out.select("o_custkey", "n", F.col("total").cast("double").alias("total"))


@query("cdc_17b_refresh_after_changes", """
WITH a AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 10 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 11 <> 0)
SELECT o_custkey, count(*) AS n, round(sum(price::DECIMAL(18,2))::DOUBLE, 2) AS total, min(price::DECIMAL(18,2))::DOUBLE AS least, max(price::DECIMAL(18,2))::DOUBLE AS most
FROM a GROUP BY 1
""")
def refresh_changes(t):
    """Inserts, updates and deletes of orders; base rows are read for customers only whose smallest or largest order was retracted."""
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    before = t.orders.filter("o_orderkey % 13 <> 0").select("o_orderkey", "o_custkey", price)
    after = t.orders.filter("o_orderkey % 11 <> 0").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 5 == 0, price + 10).otherwise(price).cast("decimal(18,2)").alias("price"))
    base = KeyedTable(t.spark, durable.scratch_dir(t.spark, "orders"), ["o_custkey", "o_orderkey"])
    base.create(after)
    feed = durable.cut(H.change_feed(before, after, ["o_orderkey"]), "feed")
    stored = durable.cut(H.summed(before, ["o_custkey"], "price"), "stored")
    out = H.refresh_by_deltas(stored, feed, base.rows_of, ["o_custkey"], "price")
    return out.select("o_custkey", "n", *[F.col(c).cast("double").alias(c) for c in ("total", "least", "most")])


@query("cdc_18_snapshot", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'")
def snapshot(t):
    return durable.cut(t.orders.filter(F.col("o_orderdate") < ntz("1999-01-01")).select("o_orderkey", "o_totalprice"), "snapshot")


@query("cdc_19_monthly_backfill", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
""")
def backfill(t):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    aggs = [F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")]
    lost = (F.col("o_orderdate") >= ntz("1997-01-01")) & (F.col("o_orderdate") < ntz("1998-01-01"))
    stored = t.orders.filter(~lost | (F.col("o_orderkey") % 2 == 0)).groupBy(month).agg(*aggs)
    again = t.orders.filter(lost).groupBy(month).agg(*aggs)  # all twelve months in one job, then one merge
    return H.upsert(stored, again, ["month"])
