"""Sources and sinks (2.1). Files are written below the shared scratch folder and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.literals import ntz
from lakeloom.functions.split import digest100
from lakeloom.catalog._sql import digest100 as d100
from lakeloom.plans import durable
from lakeloom.plans.skew import estimated_bytes
from lakeloom.registry import query
from lakeloom.sources import files
from lakeloom.sources.clustered import ClusteredTable
from lakeloom.streaming import runner


@query("src_01_table_scan", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01' AND l_quantity < 10
""")
def scan(t):
    return t.lineitem.filter((F.col("l_shipdate") >= ntz("2001-06-01")) & (F.col("l_quantity") < 10)).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("src_02_copy_into", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
""")
def copy_into(t):
    root = durable.scratch_dir(t.spark, "copy")
    early = F.col("o_orderdate") < ntz("1998-01-01")
    schema = T.StructType([T.StructField(c, t.orders.schema[c].dataType) for c in ("o_orderkey", "o_orderstatus", "o_totalprice")])
    log = files.LoadLog(t.spark, f"{root}/log")
    for part in (early, ~early):
        t.orders.filter(part).select(*schema.names).write.mode("append").csv(f"{root}/in", header=True)
        for _ in range(2):  # nothing is new the second time
            files.load_new_files(
                t.spark, f"{root}/in", lambda paths: t.spark.read.schema(schema).csv(paths, header=True), f"{root}/table", log, "*.csv")
    return log.table(f"{root}/table").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("src_03_read_with_file_metadata", """
SELECT c_custkey, c_name, c_acctbal, true AS has_path, true AS has_time FROM customer
""")
def metadata(t):
    root = durable.scratch_dir(t.spark, "json")
    t.customer.write.json(root)
    df = files.with_file_metadata(t.spark.read.schema(t.customer.schema).json(root))
    return df.select("c_custkey", "c_name", "c_acctbal", F.col("file_path").contains("/json-").alias("has_path"),
                     F.col("file_time").isNotNull().alias("has_time"))


@query("src_04_incremental_files", "SELECT event_id, user_id, value FROM events")
def incremental(t):
    root = durable.scratch_dir(t.spark, "incremental")
    half = digest100("event_id") < 50
    for turn, part in enumerate((half, ~half)):
        t.events.filter(part).select("event_id", "user_id", "value").write.json(f"{root}/in/part{turn}")
        source = runner.file_stream(t.spark, f"{root}/in/*", t.events.select("event_id", "user_id", "value").schema, "json")
        runner.append_to(source, f"{root}/out", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/out")


@query("src_05_schema_hints", """
SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey, s_acctbal::DOUBLE AS s_acctbal FROM supplier
""")
def hints(t):
    root = durable.scratch_dir(t.spark, "hints")
    t.supplier.write.csv(root, header=True)
    return files.read_csv(t.spark, root, {"s_suppkey": "string", "s_acctbal": "decimal(12,2)"})


@query("src_06_bytes_to_columns", """
SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events
""")
def bytes_json(t):
    messages = t.events.select("event_id", F.encode("props", "UTF-8").alias("value"))
    return messages.withColumn("data", F.from_json(F.col("value").cast("string"), "k int")).select("event_id", "data.*")


@query("src_07_binary_files", "SELECT count(*) AS lines, true AS named FROM benchmark")
def binary(t):
    root = durable.scratch_dir(t.spark, "binary")
    t.benchmark.write.option("maxRecordsPerFile", 1000).json(root)
    blobs = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root)
    text = F.decode("content", "UTF-8")
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return blobs.agg(F.sum(lines).cast("bigint").alias("lines"), F.bool_and(F.col("path").endswith(".json")).alias("named"))


@query("src_08_partitioned_write", """
SELECT strftime(o_orderdate, '%Y') AS year, o_orderkey, o_totalprice FROM orders WHERE strftime(o_orderdate, '%Y') = '1997'
""")
def partitioned(t):
    root = durable.scratch_dir(t.spark, "partitioned")
    files.write_partitioned(t.orders.withColumn("year", F.date_format("o_orderdate", "yyyy")), root, ["year"])
    read = t.spark.read.option("basePath", root).parquet(root)
    return read.filter(F.col("year") == 1997).select(F.col("year").cast("string").alias("year"), "o_orderkey", "o_totalprice")


@query("src_09_replace_partitions", """
SELECT year(o_orderdate)::INT AS year, count(*) AS n, round(sum(CASE WHEN year(o_orderdate) = 1998 THEN -o_totalprice ELSE o_totalprice END), 2) AS total
FROM orders GROUP BY 1
""")
def replaced(t):
    root = durable.scratch_dir(t.spark, "replace")
    base = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    files.replace_partitions(base, root, ["year"])
    fix = base.filter("year = 1998").withColumn("o_totalprice", -F.col("o_totalprice"))
    for _ in range(2):  # a rerun changes nothing
        files.replace_partitions(fix.select(base.columns), root, ["year"])
    return t.spark.read.parquet(root).groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("src_10_overwrite_summary", """
SELECT ts::DATE::VARCHAR AS day, event_type, count(*) AS n FROM events GROUP BY ts::DATE, 2
""")
def summary(t):
    root = durable.scratch_dir(t.spark, "summary")
    daily = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    for _ in range(2):
        daily.write.mode("overwrite").parquet(root)
    return t.spark.read.parquet(root)


@query("src_11_schema_merge", """
SELECT c_custkey, c_name, NULL::VARCHAR AS c_mktsegment FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 1
""")
def merged(t):
    root = durable.scratch_dir(t.spark, "merge")
    even = t.customer.filter("c_custkey % 2 = 0").select("c_custkey", "c_name")
    odd = t.customer.filter("c_custkey % 2 = 1").select("c_custkey", "c_name", "c_mktsegment")
    return files.append_merged(t.spark, root, even, odd)


@query("src_12_rescued_data", """
SELECT CASE WHEN event_id % 9 IN (4, 5) THEN 'rescued' ELSE 'clean' END AS kind, count(*) AS n,
 sum(CASE event_id % 9 WHEN 4 THEN NULL WHEN 5 THEN 7 ELSE json_extract_string(props, '$.k')::INT END)::BIGINT AS total,
 count(DISTINCT CASE event_id % 9 WHEN 4 THEN 'text ' || event_id WHEN 5 THEN 'field ' || event_id % 4 END) AS texts FROM events GROUP BY 1
""")
def rescue(t):
    wrong = F.concat(F.lit('{"k": "bad-'), F.col("event_id").cast("string"), F.lit('"}'))
    wider = F.concat(F.lit('{"k": 7, "extra": "'), (F.col("event_id") % 4).cast("string"), F.lit('"}'))
    text = F.when(F.col("event_id") % 9 == 4, wrong).when(F.col("event_id") % 9 == 5, wider).otherwise(F.col("props"))
    raw = t.events.select("event_id", text.alias("body"))
    parsed = files.rescued(raw, "body", T.StructType([T.StructField("k", T.IntegerType())]))
    kind = F.when(F.col("_rescued_data").isNotNull(), "rescued").otherwise("clean")
    return parsed.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("n"), F.sum("k").alias("total"), F.countDistinct("_rescued_data").alias("texts"))


@query("src_13_clustered_compaction", """
SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem WHERE l_suppkey BETWEEN 10 AND 20 GROUP BY 1
""")
def compaction(t):
    root = durable.scratch_dir(t.spark, "cluster")
    files.cluster_by(t.lineitem.select("l_suppkey", "l_shipdate", "l_quantity"), root, ["l_suppkey", "l_shipdate"])
    return t.spark.read.parquet(root).filter(F.col("l_suppkey").between(10, 20)).groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("src_13b_clustered_on_two_columns", """
SELECT 'supplier' AS filter, count(*) AS n, sum(l_quantity) AS qty, true AS pruned FROM lineitem WHERE l_suppkey BETWEEN 3 AND 3
UNION ALL SELECT 'date', count(*), sum(l_quantity), true FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-20'
UNION ALL SELECT 'both', count(*), sum(l_quantity), true FROM lineitem WHERE l_suppkey BETWEEN 3 AND 3 AND l_shipdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-20'
""")
def two_columns(t):
    """Two arrivals, clustered one by one; a range of either column reads some of the files only. Small tables get 64 files, large ones files of 128 MB."""
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate", "l_quantity")
    file_bytes = min(files.FILE_BYTES, -(-estimated_bytes(rows) // 64))
    table = ClusteredTable(t.spark, durable.scratch_dir(t.spark, "curve"), ["l_suppkey", "l_shipdate"], file_bytes)
    for part in (F.col("l_orderkey") % 4 > 0, F.col("l_orderkey") % 4 == 0):
        table.add(rows.filter(part).drop("l_orderkey"))
    supplier, days = (3, 3), (dt.datetime(1997, 3, 1), dt.datetime(1997, 3, 20))
    found = []
    for name, bounds in (("supplier", {"l_suppkey": supplier}), ("date", {"l_shipdate": days}), ("both", {"l_suppkey": supplier, "l_shipdate": days})):
        some, read, every = table.read(**bounds)
        found.append(some.agg(F.lit(name).alias("filter"), F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.lit(read < every).alias("pruned")))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("src_14_generated_events", f"""
WITH g AS (SELECT c_custkey, n, {d100("c_custkey || ':' || n")} AS h FROM customer, range(1, 6) r(n))
SELECT CASE WHEN h < 55 THEN 'VIEW' WHEN h < 85 THEN 'CLICK' ELSE 'BUY' END AS kind, count(*) AS n,
 min(TIMESTAMP '2024-01-01' + to_seconds(h * 3600))::VARCHAR AS first, max(TIMESTAMP '2024-01-01' + to_seconds(h * 3600))::VARCHAR AS last
FROM g GROUP BY 1
""")
def generated(t):
    """Records per known device with weighted categories, seeded by a digest instead of a random generator."""
    pool = t.customer.select("c_custkey", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("n"))
    h = digest100(F.concat_ws(":", F.col("c_custkey").cast("string"), F.col("n").cast("string")))
    rows = pool.withColumn("h", h).select(
        F.when(F.col("h") < 55, "VIEW").when(F.col("h") < 85, "CLICK").otherwise("BUY").alias("kind"),
        (ntz("2024-01-01") + F.expr("make_dt_interval(0, 0, 0, h * 3600)")).alias("ts"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
