"""Sort, limit, sampling and set operations (2.6, 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalog._sql import digest100 as d100
from lakeloom.functions.literals import ntz
from lakeloom.functions.split import digest100
from lakeloom.operators import graph
from lakeloom.registry import query


@query("srt_01_multi_key_sort", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY c_nationkey ASC NULLS LAST, c_acctbal DESC, c_custkey
""")
def multi_sort(t):
    return t.customer.select("c_custkey", "c_nationkey", "c_acctbal").orderBy(
        F.asc_nulls_last("c_nationkey"), F.desc("c_acctbal"), "c_custkey")


@query("srt_02_top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def top_k(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("srt_03_stable_split", f"""
SELECT CASE WHEN {d100("o_orderkey")} < 80 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
 round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
""")
def split(t):
    part = F.when(digest100("o_orderkey") < 80, "train").otherwise("test")
    return t.orders.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("srt_04_fraction_sample", f"""
SELECT event_id, event_type FROM events WHERE {d100("event_id")} < 10
""")
def sample(t):
    return t.events.filter(digest100("event_id") < 10).select("event_id", "event_type")


V0 = "o_orderdate < TIMESTAMP '2000-01-01'"
V1 = "o_orderdate >= TIMESTAMP '1996-01-01'"


def _versions(t):
    cols = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    keep = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    return (cols.filter(F.col("o_orderdate") < ntz("2000-01-01")).select(keep),
            cols.filter(F.col("o_orderdate") >= ntz("1996-01-01")).select(keep))


@query("set_01_union_all", f"""
SELECT 'v0' AS version, count(*) AS n FROM orders WHERE {V0} UNION ALL SELECT 'v1', count(*) FROM orders WHERE {V1}
""")
def union_all(t):
    v0, v1 = _versions(t)
    return v0.agg(F.count("*").alias("n")).select(F.lit("v0").alias("version"), "n").unionByName(
        v1.agg(F.count("*").alias("n")).select(F.lit("v1").alias("version"), "n"))


@query("set_02_many_flows", """
SELECT 'order' AS flow, o_orderkey AS id, o_totalprice AS amount FROM orders
UNION ALL SELECT 'event', event_id, value FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'balance', c_custkey, c_acctbal FROM customer
""")
def flows(t):
    sources = [
        t.orders.select(F.lit("order").alias("flow"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")),
        t.events.filter("event_type = 'purchase'").select(
            F.lit("event").alias("flow"), F.col("event_id").alias("id"), F.col("value").alias("amount")),
        t.customer.select(F.lit("balance").alias("flow"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount")),
    ]
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s)
    return out


@query("set_03_in_both", f"""
SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE {V0}
INTERSECT SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE {V1}
""")
def in_both(t):
    v0, v1 = _versions(t)
    return v0.intersect(v1)


@query("set_04_in_one_only", f"""
SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE {V0}
EXCEPT ALL SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE {V1}
""")
def in_one(t):
    v0, v1 = _versions(t)
    return v0.exceptAll(v1)


@query("set_05_reachability", """
WITH RECURSIVE e AS (SELECT DISTINCT c_custkey // 2 AS source, c_custkey AS target FROM customer
  UNION SELECT DISTINCT c_custkey, c_nationkey::BIGINT FROM customer),
 r AS (SELECT 3::BIGINT AS node, 0 AS hops UNION SELECT target, hops + 1 FROM r JOIN e ON source = node WHERE hops < 5)
SELECT node, min(hops)::BIGINT AS hops FROM r GROUP BY node HAVING min(hops) > 0
""")
def reachability(t):
    c = t.customer
    edges = c.select(F.expr("c_custkey div 2").alias("source"), F.col("c_custkey").alias("target")).unionByName(
        c.select(F.col("c_custkey").alias("source"), F.col("c_nationkey").cast("bigint").alias("target")))
    start = c.filter("c_custkey = 3").select(F.col("c_custkey").alias("node"))
    return graph.reachable(edges, start, 5)
