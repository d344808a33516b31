"""Streaming operators: windows, joins, deduplication, state, quality and upserts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakeloom.operators import quality
from lakeloom.plans import skew
from lakeloom.sources.keyed import KeyedTable
from lakeloom.streaming import runner


def _span(df: DataFrame, *rest: str) -> DataFrame:
    utc = [F.col(f"window.{s}").cast("timestamp_ntz").alias(f"window_{s}") for s in ("start", "end")]
    return df.select(*utc, *rest)


def tumbling(events: DataFrame, size: str, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    agg = events.groupBy(F.window("ts", size), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return _span(agg, *keys, *aggs)


def sliding(events: DataFrame, size: str, slide: str, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    agg = events.groupBy(F.window("ts", size, slide), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return _span(agg, *keys, *aggs)


MERGE_EARLY = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def sessions(events: DataFrame, gap: str, key: str) -> DataFrame:
    """Sessions per key; start it with ``MERGE_EARLY``, which merges rows of one task before the shuffle, so that a hot key sends few of them."""
    agg = events.groupBy(F.session_window("ts", gap).alias("window"), key).agg(F.count("*").alias("events"))
    return _span(agg, key, "events")


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, hours: int,
                  how: str = "leftOuter") -> DataFrame:
    """Stream-stream join of right events within ``hours`` after a left event of the same key.

    The hour slot joins the equi-key, so the state of a hot key is spread over its hours.
    """
    slot = hours * 3600
    a = left.withColumn("__slot", F.floor(F.unix_seconds(left_time) / slot))
    own = F.floor(F.unix_seconds(right_time) / slot)
    b = right.withColumn("__rslot", F.explode(F.array(own, own - 1))).withColumnRenamed(key, "__rkey")
    on = ((F.col(key) == F.col("__rkey")) & (F.col("__slot") == F.col("__rslot"))
          & (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {hours} HOURS")))
    return a.join(b, on, how).drop("__slot", "__rslot", "__rkey")


def split_batches(stream: DataFrame, rules: dict[str, Column], label: str) -> tuple[DataFrame, DataFrame]:
    """One input, two outputs: valid rows and quarantined rows, written per micro-batch."""
    def write(df: DataFrame, batch: int, root: str) -> None:
        shared = df.persist()
        try:
            good, bad = quality.quarantine(shared, rules)
            good.write.mode("overwrite").parquet(f"{root}/good/b={batch}")
            bad.write.mode("overwrite").parquet(f"{root}/bad/b={batch}")
        finally:
            shared.unpersist()

    _, root = runner.each_batch(stream, label, write)
    spark = stream.sparkSession
    return spark.read.parquet(f"{root}/good/b=*"), spark.read.parquet(f"{root}/bad/b=*")


def last_hour_medallion(
    raw: DataFrame, must: dict[str, Column], expected: dict[str, Column], rules: dict[str, Column], about: DataFrame, on: Column,
    root: str, max_files: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """(gold, report): three chained streams from files of raw rows to counts and sums per region and type over the last hour.

    Bronze keeps the rows with their file; a row that breaks one of ``must`` stops the stream, those of ``expected`` that a row misses are
    noted. Silver takes the rows that miss none and pass ``rules``, ``max_files`` files at a trigger, joined with ``about`` (which has
    a region), in a folder per hour. Gold is made anew after each silver batch from the last two hours' folders, which hold the last
    hour. The report counts bronze rows and the misses of each expectation. ``raw`` is a file stream with ts, event_type and value.
    """
    spark = raw.sparkSession
    missed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), n) for n, c in expected.items()]), lambda n: n.isNotNull())
    bronze = quality.fail_on_bad(raw.select("*", F.col("_metadata.file_path").alias("source_file")), must).withColumn("missed", missed)
    runner.append_to(bronze, f"{root}/bronze", f"{root}/c1")
    noted = runner.table_stream(spark, f"{root}/bronze", bronze.schema, max_files)
    good = quality.drop_bad(noted.filter(F.size("missed") == 0), rules).join(about, on)
    silver = good.select("ts", "region", "event_type", "value", F.date_format("ts", "yyyyMMddHH").alias("hour"))
    runner.append_to(silver, f"{root}/silver", f"{root}/c2", by=["hour"])

    def gold() -> DataFrame:
        rows = spark.read.schema(silver.schema).parquet(f"{root}/silver")
        start = F.date_format(F.to_timestamp(rows.agg(F.max("hour")).scalar(), "yyyyMMddHH") - F.expr("INTERVAL 1 HOUR"), "yyyyMMddHH")
        recent = rows.filter(F.col("hour") >= start)
        recent = recent.filter(F.col("ts") > recent.agg(F.max("ts")).scalar() - F.expr("INTERVAL 1 HOUR"))
        return recent.groupBy("region", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))

    last = runner.replace_each_batch(runner.table_stream(spark, f"{root}/silver", silver.schema, 50 * max_files), f"{root}/gold", gold)
    report = spark.read.schema(bronze.schema).parquet(f"{root}/bronze").agg(
        F.count("*").alias("rows"), *[F.count_if(F.array_contains("missed", n)).alias(n) for n in expected])
    return last, report


def upsert_batches(stream: DataFrame, keys: list[str], seq: list[str], label: str) -> DataFrame:
    """Latest row per key, merged batch by batch into ranges of the key; a batch reads and writes only the ranges it reaches.

    The table keeps the number of the last batch it took in, so a replayed one changes nothing.
    """
    order = [F.desc(c) for c in seq]

    def write(df: DataFrame, batch: int, root: str) -> None:
        table = KeyedTable(df.sparkSession, f"{root}/table", keys)
        newest = skew.latest_per_key(df, keys, order)
        if table.version() < 0:
            table.create(newest, batch)
        else:
            table.merge(newest, newest=order, batch=batch)

    _, root = runner.each_batch(stream, label, write)
    return KeyedTable(stream.sparkSession, f"{root}/table", keys).read()


STATE = "n long, first_us long, last_us long, spent double"
OUT = "user_id long, part long, n long, first_us long, last_us long, spent double"


COMBINED = "user_id long, part long, n long, first_us long, last_us long, spent double"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per user and part of a batch of rows."""
    for b in batches:
        sums = pa.Table.from_batches([b]).group_by(["user_id", "part"]).aggregate(
            [([], "count_all"), ("us", "min"), ("us", "max"), ("value", "sum")])
        yield from sums.select(["user_id", "part", "count_all", "us_min", "us_max", "value_sum"]).rename_columns(
            ["user_id", "part", "n", "first_us", "last_us", "spent"]).to_batches()


def _advance(key, chunks, state: GroupState):
    n, first, last, spent = state.get if state.exists else (0, 2**62, -(2**62), 0.0)
    for c in chunks:
        timed = c.dropna(subset=["first_us"])
        n += int(c["n"].sum())
        if len(timed):
            first, last = min(first, int(timed["first_us"].min())), max(last, int(timed["last_us"].max()))
        spent += float(c["spent"].sum())
    state.update((n, first, last, spent))
    import pandas as pd

    span = (first, last) if first <= last else (None, None)
    yield pd.DataFrame([(*key, n, *span, spent)], columns=["user_id", "part", "n", "first_us", "last_us", "spent"])


def user_state(events: DataFrame, parts: int = 1) -> DataFrame:
    """Running state per (user, part).

    A task sends one row per user and batch of its rows to the state, so a hot user sends few of them and needs no more than one part.
    """
    keyed = events.select(
        "user_id", F.pmod("event_id", F.lit(parts)).alias("part"), F.unix_micros("ts").alias("us"), "value")
    return keyed.mapInArrow(_combine, COMBINED).groupBy("user_id", "part").applyInPandasWithState(
        _advance, OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def merge_user_state(states: DataFrame) -> DataFrame:
    return states.groupBy("user_id").agg(
        F.sum("n").alias("events"), F.round(F.sum("spent"), 2).alias("spent"),
        ((F.max("last_us") - F.min("first_us")) / 1000000).cast("bigint").alias("span_sec"))
