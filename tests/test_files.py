"""Loads by file list: old files stay closed, a failed load repeats nothing, loads and partitions are even."""

import os

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import durable
from lakeloom.sources import files
from lakeloom.sources.clustered import ClusteredTable

SCHEMA = "id long, v string"


@pytest.fixture
def load(spark):
    root = durable.scratch_dir(spark, "copy").removeprefix("file:")
    log = files.LoadLog(spark, f"{root}/log")

    def arrive(name, ids):
        os.makedirs(f"{root}/in/{name[0]}", exist_ok=True)
        with open(f"{root}/in/{name[0]}/{name}.csv", "w") as f:
            f.write("id,v\n" + "".join(f"{i},{name}\n" for i in ids))

    def run(read=None):
        return files.load_new_files(spark, f"{root}/in", read or (lambda paths: spark.read.schema(SCHEMA).csv(paths, header=True)), f"{root}/table", log)

    arrive.root, arrive.log, arrive.run = root, log, run
    return arrive


def rows(load):
    return sorted((r.id, r.v) for r in load.log.table(f"{load.root}/table").collect())


def test_second_load_opens_no_old_file(spark, load):
    load("a1", range(10))
    load("b 2", range(10, 20))
    assert load.run() == 2 and load.run() == 0
    load("a3", range(20, 25))
    # an old file that is opened now would fail the load
    with open(f"{load.root}/in/a/a1.csv", "w") as f:
        f.write("broken")
    seen = []

    def read(paths):
        seen.extend(paths)
        return spark.read.schema(SCHEMA).option("mode", "FAILFAST").csv(paths, header=True)

    assert load.run(read) == 1 and [os.path.basename(p) for p in seen] == ["a3.csv"]
    assert [i for i, _ in rows(load)] == list(range(25))
    logged = {os.path.basename(r.path).replace("%20", " "): r.length for r in load.log.loaded().collect()}
    assert set(logged) == {"a1.csv", "b 2.csv", "a3.csv"} and min(logged.values()) > 10


def test_failure_between_rows_and_log_repeats_nothing(spark, load, monkeypatch):
    load("a1", range(10))
    assert load.run() == 1
    load("a2", range(10, 20))
    monkeypatch.setattr(files.LoadLog, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        load.run()
    monkeypatch.undo()
    assert [i for i, _ in rows(load)] == list(range(10))
    load("a3", range(20, 30))
    assert load.run() == 2
    assert [i for i, _ in rows(load)] == list(range(30))


def test_wider_files_keep_older_rows(spark, load):
    load("a1", range(3))
    load.run()
    load("a2", range(3, 5))
    load.run(lambda paths: spark.read.schema(SCHEMA).csv(paths, header=True).withColumn("more", F.lit(1)))
    got = {r.id: r.more for r in load.log.table(f"{load.root}/table").collect()}
    assert got == {0: None, 1: None, 2: None, 3: 1, 4: 1}


def test_replaced_partitions_are_in_few_files(spark):
    root = durable.scratch_dir(spark, "replace").removeprefix("file:")
    df = spark.range(4000).select("id", (F.col("id") % 5).alias("p")).repartition(16)
    files.replace_partitions(df, root, ["p"])
    files.replace_partitions(df.filter("p = 2").withColumn("id", -F.col("id")), root, ["p"])
    got = {r.p: r.s for r in spark.read.parquet(root).groupBy("p").agg(F.sum("id").alias("s")).collect()}
    assert got == {p: (-1 if p == 2 else 1) * sum(range(p, 4000, 5)) for p in range(5)}
    assert all(len([f for f in os.listdir(f"{root}/p={p}") if f.endswith(".parquet")]) == 1 for p in range(5))


def test_open_table(spark, tmp_path):
    log = files.LoadLog(spark, f"{tmp_path}/log")
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/in/old name")
    assert files.copy_into(spark.read.parquet(f"{tmp_path}/in/old name"), f"{tmp_path}/out", log) == 1
    spark.range(10, 15).coalesce(1).write.parquet(f"{tmp_path}/in/new")
    source = spark.read.schema("id long").parquet(f"{tmp_path}/in/old name", f"{tmp_path}/in/new")
    assert files.copy_into(source, f"{tmp_path}/out", log) == 1 and files.copy_into(source, f"{tmp_path}/out", log) == 0
    assert sorted(r.id for r in log.table(f"{tmp_path}/out").collect()) == list(range(15))


def test_ranges_of_either_column_read_few_files(spark):
    df = spark.range(20_000).select("id", (F.xxhash64("id") % 1000).alias("a"), F.pmod(F.xxhash64(F.lit("b"), "id"), F.lit(365)).alias("b"),
                                    F.when(F.col("id") % 50 > 0, F.concat(F.lit("v"), F.col("id").cast("string"))).alias("c"))
    table = ClusteredTable(spark, durable.scratch_dir(spark, "curve"), ["a", "b"], file_bytes=1)
    table.file_bytes = max(1, files.estimated_bytes(df.filter("id % 10 < 8")) // 64)
    table.add(df.filter("id % 10 < 8"))
    first = {r.file for r in table.ranges().collect()}
    table.add(df.filter("id % 10 >= 8"))
    assert first < {r.file for r in table.ranges().collect()}  # earlier files stay
    for turn in range(2):
        for bounds, test in (({"a": (-20, 20)}, "a BETWEEN -20 AND 20"), ({"b": (100, 110)}, "b BETWEEN 100 AND 110"),
                             ({"a": (500, None), "b": (None, 30)}, "a >= 500 AND b <= 30"), ({"a": (5000, None)}, "a > 5000")):
            rows, read, every = table.read(**bounds)
            want = df.filter(test)
            assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
            assert read <= every * 0.4, (bounds, read, every)
        table.compact()
        assert len({r.file.rsplit("/", 1)[0] for r in table.ranges().collect()}) == 1


def test_well_compressed_rows_are_sorted_by_several_tasks(spark, monkeypatch):
    """Files of some KB whose rows hold 800 KB: the size of the files alone would make it one task."""
    path = durable.scratch_dir(spark, "test-compaction")
    spark.range(100_000).select(F.lit(7).cast("bigint").alias("v")).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert files.estimated_bytes(df) < 100_000 and files.file_count(df) == 1
    monkeypatch.setattr(files, "SORT_BYTES", 100_000)
    assert files.file_count(df) == 8


def test_nulls_and_one_value_in_a_clustered_column(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("a"), F.lit(7).alias("b"))
    table = ClusteredTable(spark, durable.scratch_dir(spark, "curve"), ["a", "b"])
    table.add(df)
    assert table.read()[0].exceptAll(df).isEmpty() and table.read(b=(7, 7))[0].count() == 500 and table.read(a=(10, 11))[0].count() == 2
