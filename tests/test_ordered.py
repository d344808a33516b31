"""Bucketed ordered operators against plain windows, with buckets small enough to be crossed often."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators import retrieval
from lakeloom.plans import ordered


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [(rng.choice([1, 1, 1, 2, 3]), i, rng.randint(0, 60), rng.choice([None, rng.randint(0, 9)])) for i in range(400)]
    return spark.createDataFrame(data, "k long, id long, v long, x long").persist()


def by_value():
    return Window.partitionBy("k").orderBy("v", "id")


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("forward", [False, True])
def test_neighbor(rows, forward):
    got = ordered.neighbor(rows, ["k"], ["v", "id"], F.floor(F.col("v") / 5), {"n": F.col("id")}, forward)
    same(got, rows.withColumn("n", (F.lead if forward else F.lag)("id").over(by_value())))


def test_running_and_position(rows):
    got = ordered.running(rows, ["k"], ["v", "id"], F.floor(F.col("v") / 5), {"s": F.col("id")}, totals=True)
    upto = by_value().rowsBetween(Window.unboundedPreceding, 0)
    same(got, rows.withColumns({"s": F.sum("id").over(upto), "s_total": F.sum("id").over(Window.partitionBy("k"))}))
    pos = ordered.position(rows, ["k"], ["v", "id"], F.floor(F.col("v") / 5))
    same(pos, rows.withColumn("pos", F.row_number().over(by_value())))


def test_carry_forward(rows):
    got = ordered.carry_forward(rows, ["k"], ["v", "id"], F.floor(F.col("v") / 5), F.col("x"), "last_x")
    same(got, rows.withColumn("last_x", F.last("x", ignorenulls=True).over(by_value())))


def test_carry_forward_over_empty_and_null_buckets(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 50, None), (1, 99, None), (2, 3, None)], "k long, v long, x long")
    got = {(r.k, r.v): r.c for r in ordered.carry_forward(df, ["k"], ["v"], F.col("v"), F.col("x"), "c").collect()}
    assert got == {(1, 1): 5, (1, 50): 5, (1, 99): 5, (2, 3): None}


def test_quantiles(rows):
    got = ordered.exact_quantiles(rows, ["k"], "x", {"a": 0.25, "b": 0.5, "c": 0.95}, 2.0)
    want = rows.groupBy("k").agg(*[F.round(F.percentile("x", p), 9).alias(n) for n, p in (("a", 0.25), ("b", 0.5), ("c", 0.95))])
    same(got.select("k", *[F.round(c, 9).alias(c) for c in "abc"]), want)


def test_ranks_with_ties_across_ranges(spark):
    df = spark.createDataFrame([(1, i, float(i % 3)) for i in range(60)], "k long, id long, v double")
    got = ordered.ranks(df, ["k"], "v", "id")
    w = Window.partitionBy("k").orderBy(F.desc("v"))
    wid = Window.partitionBy("k").orderBy(F.desc("v"), "id")
    want = df.select("*", F.row_number().over(wid).cast("bigint").alias("row_number"), F.rank().over(w).cast("bigint").alias("rank"),
                     F.dense_rank().over(w).cast("bigint").alias("dense_rank"), F.ntile(4).over(wid).cast("bigint").alias("ntile"))
    same(got, want)


def test_context_windows_cross_blocks(spark):
    df = spark.createDataFrame([(1, i, "u", f"m{i}") for i in range(50)], "c long, turn long, role string, text string")
    got = {r.turn: r.context for r in retrieval.context_windows(df, "c", "turn", "role", "text", 3, block=4).collect()}
    assert len(got) == 50
    assert all(got[i] == [f"u: m{j}" for j in range(max(0, i - 3), i)] for i in range(50))


def many(spark, n=3000, users=40):
    """A third of the rows in one key, half of those at one time; a key of NULL values; ties in the first order column."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        k = 0 if i % 3 == 0 else rng.randint(1, users)
        ts = 500 if k == 0 and rng.random() < 0.5 else rng.randint(0, 1000)
        data.append((k, ts, i, rng.choice([None, rng.randint(0, 9)]) if k != 7 else None, rng.choice(["a", "b", None])))
    return spark.createDataFrame(data, "k long, ts long, id long, x long, s string").repartition(4).persist()


def expected_scan(df):
    w = Window.partitionBy("k").orderBy("ts", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    flagged = df.withColumn("new", F.lag(F.lit(1)).over(w).isNull() | ~F.lag("s").over(w).eqNullSafe(F.col("s")))
    return flagged.select(
        "k", "ts", "id", F.lag("id").over(w).alias("b"), F.lag("x").over(w).alias("bx"), F.lead("x").over(w).alias("a"),
        F.sum("x").over(upto).alias("total"), F.row_number().over(w).cast("bigint").alias("pos"),
        F.sum("x").over(Window.partitionBy("k")).alias("total_total"), F.last("x", ignorenulls=True).over(upto).alias("seen"),
        F.last(F.when(F.col("new"), F.col("id")), ignorenulls=True).over(upto).alias("run"))


@pytest.mark.parametrize("sampled, with_runs", [(64, False), (8, False), (8, True), (2, True)])
def test_scan_equals_plain_windows(spark, monkeypatch, sampled, with_runs):
    monkeypatch.setattr(ordered, "SAMPLED", sampled)
    df = many(spark)
    got = ordered.scan(
        df, ["k"], ["ts", "id"], before={"b": F.col("id"), "bx": F.col("x")}, after={"a": F.col("x")},
        sums={"total": F.col("x"), "pos": F.lit(1).cast("bigint")}, totals=["total"], last={"seen": F.col("x")},
        runs={"run": (F.col("s"), F.col("id"))} if with_runs else None)
    want = expected_scan(df)
    cols = [c for c in want.columns if with_runs or c != "run"]
    same(got.select(*cols), want.select(*cols))


def test_buckets_follow_the_data(spark, monkeypatch):
    """The hot key is cut inside its crowded time too; keys with few rows stay whole; buckets grow with the order."""
    monkeypatch.setattr(ordered, "SAMPLED", 8)
    df = many(spark)
    rows = ordered.by_load(df, ["k"], ["ts", "id"], ordered.borders_by_load(df, ["k"], ["ts", "id"]))
    sizes = [r["n"] for r in rows.filter("k = 0").groupBy("__bucket").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 20 and max(sizes) <= 4 * 1000 / len(sizes)
    assert rows.filter("k <> 0 AND ts = 500 AND __bucket < 0").isEmpty()
    w = Window.partitionBy("k").orderBy("ts", "id")
    assert rows.withColumn("p", F.lag("__bucket").over(w)).filter("p > __bucket").isEmpty()


def test_largest_task_stays_near_the_mean(spark):
    """A third of 200,000 rows in one key and one day: rows per shuffle partition under the buckets' hash."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), (F.xxhash64("id") % 1000).alias("ts"), "id")
    borders = ordered.borders_by_load(df, ["k"], ["ts", "id"], parts=50)
    parts = ordered.by_load(df, ["k"], ["ts", "id"], borders).repartition(50, "k", "__bucket").groupBy(F.spark_partition_id().alias("p")).count()
    biggest = parts.agg(F.max("count")).first()[0]
    assert biggest <= 2 * 200_000 / 50
