import datetime as dt
import random

from pyspark.sql import functions as F

from lakeloom.operators import joins
from lakeloom.plans import durable, skew

T0 = dt.datetime(2024, 1, 1, 12)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_salted_equals_plain(t):
    custs = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    for how in ("inner", "left", "left_semi"):
        plain = t.orders.join(custs, "o_custkey", how)
        salted = skew.salted_join(t.orders, custs, ["o_custkey"], ["o_orderkey"], how=how)
        assert salted.select(plain.columns).exceptAll(plain).isEmpty() and salted.count() == plain.count()


def test_salted_copies_are_not_broadcast_where_one_table_could_be(spark):
    """800 KB travel, their 16 copies (the optimizer does not count them) do not."""
    big = spark.range(400_000).select((F.col("id") % 100_000).alias("k"), "id")
    small = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    salted = skew.salted_join(big, small, ["k"], ["id"])
    assert "Broadcast" not in salted._jdf.queryExecution().sparkPlan().toString()
    assert salted.exceptAll(big.join(small, "k").select(salted.columns)).isEmpty() and salted.count() == 400_000
    few = skew.salted_join(big, small.filter("k < 10").limit(10), ["k"], ["id"])
    assert "Broadcast" in few._jdf.queryExecution().sparkPlan().toString()


def test_salted_copies_of_well_compressed_files_are_not_broadcast(spark):
    """The files of the small side have some KB, the copies of its rows more than 60 MB."""
    path = durable.scratch_dir(spark, "test-salted")
    spark.range(200_000).select((F.col("id") % 50).alias("k"), F.lit("one text").alias("v")).coalesce(1).write.parquet(path)
    small = spark.read.parquet(path)
    assert skew.estimated_bytes(small) * 16 < 2**20
    big = spark.range(100).select((F.col("id") % 60).alias("k"), "id")
    salted = skew.salted_join(big, small, ["k"], ["id"])
    assert "Broadcast" not in salted._jdf.queryExecution().sparkPlan().toString()
    assert salted.count() == 90 * 4000


def test_point_in_time_sees_only_the_past(spark):
    labels = spark.createDataFrame([(1, at(120))], "k long, event_time timestamp_ntz")
    feats = spark.createDataFrame(
        [(1, at(60), 10), (1, at(120), 20), (1, at(121), 30)], "k long, ts timestamp_ntz, f long")
    row = joins.asof_join(labels, feats, "k", "event_time", "ts", {"f": F.col("f")}, "f").first()
    assert row.f == 20


def test_asof_against_brute_force(spark):
    rng = random.Random(3)
    left = [(rng.randint(1, 3), at(rng.randint(0, 6000)), i) for i in range(120)]
    times = rng.sample(range(6000), 150)
    right = [(rng.randint(1, 3), at(m), m) for m in times]
    got = joins.asof_join(
        spark.createDataFrame(left, "k long, lt timestamp_ntz, id long"), spark.createDataFrame(right, "k long, rt timestamp_ntz, f long"),
        "k", "lt", "rt", {"f": F.col("f")}, "f").collect()
    want = {i: max(((rt, f) for k2, rt, f in right if k2 == k and rt <= lt), default=(None, None))[1] for k, lt, i in left}
    assert {r.id: r.f for r in got} == want


def test_interval_against_brute_force(spark):
    rng = random.Random(5)
    left = [(rng.randint(1, 2), at(rng.randint(0, 1000)), i) for i in range(60)]
    right = [(rng.randint(1, 2), at(rng.randint(0, 1000)), i) for i in range(60)]
    got = joins.interval_join(
        spark.createDataFrame(left, "k long, lt timestamp_ntz, a long"), spark.createDataFrame(right, "k long, rt timestamp_ntz, b long"),
        "k", "lt", "rt", 3600).select("a", "b").collect()
    want = []
    for k, lt, a in left:
        hits = [b for k2, rt, b in right if k2 == k and lt <= rt <= lt + dt.timedelta(hours=1)]
        want += [(a, b) for b in hits] or [(a, None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_broadcast_only_when_small(t):
    assert 0 < skew.estimated_bytes(t.region) < skew.estimated_bytes(t.lineitem)
    hinted = skew.checked_broadcast(t.region)._jdf.queryExecution().logical().toString()
    plain = skew.checked_broadcast(t.lineitem, 1000)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_star_keeps_order_lines_of_any_year(t):
    from types import SimpleNamespace

    from lakeloom.catalog import joining

    tables = {n: getattr(t, n) for n in ("spark", "nation", "region", "lineitem", "customer", "part")}
    for months in (-360, 360):
        orders = t.orders.withColumn("o_orderdate", F.add_months("o_orderdate", months))
        moved = SimpleNamespace(orders=orders, **tables)
        day = F.col("o_orderdate")
        business = ~F.dayofweek(day).isin(1, 7) & ~F.date_format(day, "MM-dd").isin(*joining.HOLIDAYS)
        want = joining._star(moved).filter(business).count()
        assert want > 0 and joining.star_by_fiscal_quarter(moved).agg(F.sum("lines")).first()[0] == want


def test_uneven_join_meets_every_row_once(spark, monkeypatch):
    """A key with half of the rows, keys of one row, a key that the small side lacks, NULL keys; also grouped afterwards on another key."""
    monkeypatch.setattr(skew, "HEADS", 10)
    big = spark.range(2000).select(
        "id", (F.col("id") % 50).alias("g"), F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 7 > 0, F.col("id")).alias("k")).repartition(8, "g")
    small = big.filter("k IS NOT NULL AND k <> 9").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    for apart in (False, True):
        got = skew.uneven_join(big, small, ["k"], "n", apart)
        want = big.join(small, "k")
        assert got.select("id", "last").exceptAll(want.select("id", "last")).isEmpty() and got.count() == want.count()
    sums = skew.uneven_join(big, small, ["k"], "n", apart=True).groupBy("g").agg(F.count("*").alias("c"), F.sum("last").alias("s"))
    want = want.groupBy("g").agg(F.count("*").alias("c"), F.sum("last").alias("s"))
    assert sums.count() == 50 and sums.exceptAll(want).isEmpty()
