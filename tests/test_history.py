import pytest
from pyspark.sql import functions as F

from lakeloom.operators import history as H
from lakeloom.operators import quality as Q
from lakeloom.sources import files


@pytest.fixture(scope="module")
def feed(spark):
    rows = [
        (1, 1, "Seoul", "UPSERT"), (1, 5, "Jeju", "UPSERT"), (1, 3, "Busan", "UPSERT"),  # arrives late
        (2, 2, "Seoul", "UPSERT"), (2, 4, "Seoul", "UPSERT"), (2, 6, "Seoul", "DELETE"), (2, 9, "Seoul", "UPSERT"),
        (3, 1, "Daegu", "UPSERT"), (3, 7, "Daegu", "DELETE"),
    ]
    return spark.createDataFrame(rows, "id long, seq long, city string, op string").persist()


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_type1(feed):
    assert rows(H.scd1(feed, ["id"], ["seq"], "op"), "id", "seq", "city") == [(1, 5, "Jeju"), (2, 9, "Seoul")]


def test_type2(feed):
    got = {(r.id, r.start_at): r.end_at for r in H.scd2(feed, ["id"], ["seq"], F.floor(F.col("seq") / 2), op="op").collect()}
    assert got == {(1, 1): 3, (1, 3): 5, (1, 5): None, (2, 2): 4, (2, 4): 6, (2, 9): None, (3, 1): 7}


def test_tracked_columns(feed):
    got = {(r.id, r.start_at): r.end_at
           for r in H.scd2(feed, ["id"], ["seq"], F.floor(F.col("seq") / 2), tracked=["city"], op="op").collect()}
    assert got == {(1, 1): 3, (1, 3): 5, (1, 5): None, (2, 2): 6, (2, 9): None, (3, 1): 7}


def test_intervals_do_not_overlap(t):
    feed = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("s"))
    hist = H.scd2(feed, ["k"], ["seq"], F.floor(F.col("seq") / 100), tracked=["s"])
    a, b = hist.alias("a"), hist.alias("b")
    clash = a.join(b, "k").filter("a.start_at < b.start_at AND (a.end_at IS NULL OR a.end_at > b.start_at)")
    assert clash.isEmpty()


def test_truncate(spark):
    df = spark.createDataFrame([(1, 1, "U"), (2, 3, "TRUNCATE"), (2, 4, "U")], "id long, seq long, op string")
    assert rows(H.after_truncate(df, "seq", "op"), "id", "seq") == [(2, 4)]
    assert H.after_truncate(df.filter("op = 'U'"), "seq", "op").count() == 2


def test_change_feed_leads_to_the_next_version(t):
    a = t.customer.filter("c_custkey % 10 <> 1")
    b = t.customer.filter("c_custkey % 10 <> 2").withColumn("c_acctbal", F.col("c_acctbal") + F.col("c_custkey") % 2)
    after = H.apply_change_feed(a, H.change_feed(a, b, ["c_custkey"]), ["c_custkey"])
    assert after.exceptAll(b).isEmpty() and b.exceptAll(after).isEmpty()


def test_merge_two_customers(spark):
    target = spark.createDataFrame([(1, "old"), (2, "b"), (3, "c")], "id long, name string")
    source = spark.createDataFrame([(1, "new"), (4, "d")], "id long, name string")
    assert rows(H.upsert(target, source, ["id"]), "id", "name") == [(1, "new"), (2, "b"), (3, "c"), (4, "d")]


def test_valid_and_quarantine_are_the_input(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id long, v long")
    good, bad = Q.quarantine(df, Q.parse({"positive": "v > 0", "known": "v IS NOT NULL"}))
    assert rows(good, "id") == [(1,)]
    assert {r.id: r.violated_rules for r in bad.collect()} == {2: ["positive"], 3: ["positive", "known"]}


def test_null_drop(spark):
    assert Q.drop_bad(spark.createDataFrame([(1,), (None,)], "x long"), Q.parse({"x": "x IS NOT NULL"})).count() == 1


def test_fail_stops_the_job(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x long")
    with pytest.raises(Exception, match="expectation violated: positive"):
        Q.fail_on_bad(df, Q.parse({"positive": "x > 0"})).collect()


def test_copy_into_skips_loaded_files(spark, tmp_path):
    log = files.LoadLog(spark, f"{tmp_path}/log")
    spark.range(5).write.parquet(f"{tmp_path}/in")
    assert files.copy_into(spark.read.parquet(f"{tmp_path}/in"), f"{tmp_path}/out", log) > 0
    assert files.copy_into(spark.read.parquet(f"{tmp_path}/in"), f"{tmp_path}/out", log) == 0
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5
