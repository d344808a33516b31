"""Merges into a table of key ranges: results, untouched folders, replays, failures, splits and deletes."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import durable
from lakeloom.sources.keyed import KeyedTable


def table(spark, rows, per_bucket=100):
    out = KeyedTable(spark, durable.scratch_dir(spark, "keyed"), ["k"], per_bucket)
    out.create(spark.createDataFrame(rows, "k long, v string, seq long"))
    return out


def content(t):
    return {r.k: (r.v, r.seq) for r in t.read().collect()}


def files_of(t):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{t.path}/data/**/*.parquet", recursive=True)}


@pytest.fixture
def base(spark):
    return table(spark, [(i, f"v{i}", 0) for i in range(1000)])


def test_only_reached_ranges_are_read_and_written(spark, base):
    before, lines = files_of(base), base.manifest().orderBy("low").collect()
    assert len(lines) >= 8
    source = spark.createDataFrame([(5, "new", 1), (7, "new", 1), (503, "new", 1)], "k long, v string, seq long")
    reached = {r.folder for r in lines if r.low.k <= 7 or (r.low.k <= 503 and not any(r.low.k < o.low.k <= 503 for o in lines))}
    # folders that the merge must not open are taken away while it runs
    away = [f for f in (r.folder.removeprefix("file:") for r in lines) if f not in {x.removeprefix("file:") for x in reached}]
    for folder in away:
        os.rename(folder, f"{folder}-away")
    report = base.merge(source)
    for folder in away:
        os.rename(f"{folder}-away", folder)
    assert (report.read, report.buckets) == (2, len(lines)) and report.written == 2
    assert {p: m for p, m in files_of(base).items() if p in before} == before
    want = {i: (f"v{i}", 0) for i in range(1000)} | {5: ("new", 1), 7: ("new", 1), 503: ("new", 1)}
    assert content(base) == want and base.read(0).filter("v = 'new'").isEmpty()


def test_random_merges_equal_a_dictionary(spark, base):
    rng, want = random.Random(1), {i: (f"v{i}", 0) for i in range(1000)}
    for turn in range(1, 4):
        rows = {rng.randint(-300, 1500): (rng.choice(["a", "b"]), turn, rng.random() < 0.3) for _ in range(150)}
        source = spark.createDataFrame([(k, *v) for k, v in rows.items()], "k long, v string, seq long, gone boolean")
        base.merge(source, delete=F.col("gone"))
        for k, (v, seq, gone) in rows.items():
            want.pop(k, None) if gone else want.update({k: (v, seq)})
    assert content(base) == want
    ranges = base.manifest().orderBy("low").collect()
    assert sum(r.rows for r in ranges) == len(want)


def test_replay_and_failure_change_nothing(spark, base):
    source = spark.createDataFrame([(1, "x", 1), (2000, "y", 1)], "k long, v string, seq long")
    assert base.merge(source, batch=4).applied
    assert not base.merge(source.withColumn("v", F.lit("replayed")), batch=4).applied
    after = content(base)
    # files of a merge that never wrote its manifest are not seen, and the next merge writes over them
    source.write.parquet(f"{base.path}/data/v{base.version() + 1}/__bucket=0/__sub=0")
    assert content(base) == after
    assert base.merge(source.withColumn("v", F.lit("z")), batch=5).applied
    assert content(base) == after | {1: ("z", 1), 2000: ("z", 1)}


def test_newest_row_wins_and_large_ranges_are_split(spark):
    t = table(spark, [(i, "old", i % 2) for i in range(100)], per_bucket=50)
    source = spark.createDataFrame([(i, "new", 0) for i in range(100)] + [(1000 + i, "add", 0) for i in range(400)], "k long, v string, seq long")
    t.merge(source, newest=[F.desc("seq")])
    got = content(t)
    assert got[2] == ("new", 0) and got[3] == ("old", 1) and len(got) == 500
    assert max(r.rows for r in t.manifest().collect()) <= 100 and t.manifest().count() > 4
    t.merge(spark.createDataFrame([(1399, "last", 9), (99, "last", 9)], "k long, v string, seq long"))
    assert content(t) == got | {1399: ("last", 9), 99: ("last", 9)}


def test_everything_deleted(spark):
    t = table(spark, [(1, "a", 0), (2, "b", 0)])
    t.merge(t.read().withColumn("gone", F.lit(True)), delete=F.col("gone"))
    assert content(t) == {}
