import random

from pyspark.sql import functions as F

from lakeloom.plans import durable
from lakeloom.streaming import jobs, pairing, runner


def _folder(t, spark, parts=3):
    root = durable.scratch_dir(spark, "test-stream")
    for i in range(parts):
        t.events.filter(F.col("event_id") % parts == i).coalesce(1).write.parquet(f"{root}/in/p{i}")
    return root


def test_upsert_over_several_batches_equals_batch(spark, t):
    root = _folder(t, spark)
    raw = runner.file_stream(spark, f"{root}/in/*", t.events.schema, max_files=1)
    got = jobs.upsert_batches(raw, ["user_id"], ["ts", "event_id"], "test-upsert")
    want = t.events.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    assert got.select("user_id", "event_id").exceptAll(want).isEmpty() and got.count() == want.count()


def test_update_mode_over_several_batches_equals_batch(spark, t):
    root = _folder(t, spark)
    raw = runner.file_stream(spark, f"{root}/in/*", t.events.schema, max_files=1)
    got = runner.mode_result(raw.groupBy("event_type").count(), "test-update", "update", ["event_type"])
    assert got.exceptAll(t.events.groupBy("event_type").count()).isEmpty()


def test_state_over_several_batches_equals_batch(spark, t):
    root = _folder(t, spark)
    raw = runner.file_stream(spark, f"{root}/in/*", t.events.schema, max_files=1)
    stream = runner.event_time(raw, "ts", "60 days")
    got = jobs.merge_user_state(runner.mode_result(jobs.user_state(stream), "test-state", "update", ["user_id", "part"]))
    want = t.events.groupBy("user_id").agg(F.count("*").alias("events"))
    assert got.select("user_id", "events").exceptAll(want).isEmpty() and got.count() == want.count()


def test_a_user_is_one_state_and_a_hot_one_sends_few_rows(spark, t):
    root = durable.scratch_dir(spark, "test-state-rows")
    t.events.coalesce(1).write.parquet(f"{root}/in/a")
    hot = t.events.select("event_id", "ts", F.lit(-1).cast("bigint").alias("user_id"), "event_type", "value", "props")
    hot.coalesce(1).write.parquet(f"{root}/in/b")
    raw = runner.file_stream(spark, f"{root}/in/*", t.events.schema)
    query, out = runner.each_batch(jobs.user_state(runner.event_time(raw, "ts", "60 days")), "test-rows", runner._write_batch, "update")
    assert query.lastProgress.stateOperators[0].numRowsTotal == t.events.select("user_id").distinct().count() + 1
    got = jobs.merge_user_state(spark.read.parquet(f"{out}/out/b=*")).filter("user_id = -1").first()
    want = t.events.agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("s")).first()
    assert got.events == want.n and abs(got.spent - want.s) < 0.02


def test_quarantine_keeps_every_row(spark, t):
    root = _folder(t, spark)
    raw = runner.file_stream(spark, f"{root}/in/*", t.events.schema, max_files=2)
    good, bad = jobs.split_batches(raw, {"big": F.col("value") > 20}, "test-quality")
    assert good.count() + bad.count() == t.events.count()
    assert good.filter("value <= 20").isEmpty()


def _pairs(events, timeout_us, mark):
    """Each start with the first later stop of its user, or timed out; left out while the mark has not passed it."""
    out = []
    for user in {e[0] for e in events}:
        mine = sorted((us, n, kind) for u, us, n, kind in events if u == user and us <= mark)
        for i, (us, n, kind) in enumerate(mine):
            if kind != "start":
                continue
            stop = next(((s, m) for s, m, k in mine[i + 1:] if k == "stop"), None)
            if stop and stop[0] - us <= timeout_us:
                out.append((user, n, us, stop[1], stop[0], "closed"))
            elif us + timeout_us <= mark:
                out.append((user, n, us, None, None, "timed out"))
    return sorted(map(str, out))


def test_open_sessions_over_batches_and_restarts(spark):
    """Events out of order within the delay, one user with a third of them, equal times; a restart goes on with the open sessions."""
    rng = random.Random(11)
    second = 1_000_000
    events = [(0 if i % 3 == 0 else rng.randint(1, 6), (i // 2) * 20 * second + rng.randint(0, 30) * second, i,
               rng.choice(["start", "start", "stop", "other"])) for i in range(600)]
    root = durable.scratch_dir(spark, "test-sessions")
    schema = "user_id long, us long, n long, kind string"

    def arrive(turn):
        part = spark.createDataFrame(events[turn * 150:turn * 150 + 150], schema).withColumn("ts", F.timestamp_micros("us")).drop("us")
        part.coalesce(1).write.parquet(f"{root}/in/{turn}")

    arrive(0)
    shape = spark.read.parquet(f"{root}/in/0").schema
    for turns in ((), (1, 2), (3,)):
        for turn in turns:
            arrive(turn)
        raw = runner.file_stream(spark, f"{root}/in/*", shape, max_files=1).withWatermark("ts", "2 minutes")
        pairs = pairing.pair_sessions(raw, "user_id", "n", "ts", F.col("kind") == "start", F.col("kind") == "stop", 5, parts=2)
        with runner.settings(spark, runner.STATE_STORE):
            last = runner.append_to(pairs, f"{root}/out", f"{root}/checkpoint")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != runner.STATE_STORE["spark.sql.streaming.stateStore.providerClass"]
    mark = (max(us for _, us, _, _ in events) - 120 * second) // 1000 * 1000
    got = sorted(str(tuple(r)) for r in spark.read.parquet(f"{root}/out").select(
        "user_id", "start_id", "start_us", "stop_id", "stop_us", "outcome").collect())
    assert got == _pairs(events, 300 * second, mark)
    # what is left in the state: events behind the mark, a day's open sessions, and one timer and its time per key
    assert last.lastProgress.stateOperators[0].numRowsTotal < 120


def test_sessions_of_many_keys_share_a_state(spark):
    """40 users and one NULL in three states give the sessions of one state each."""
    rng = random.Random(5)
    second = 1_000_000
    events = [(rng.choice([None, *range(40)]), (i + 1) * 20 * second, i, rng.choice(["start", "start", "stop"])) for i in range(400)]
    path = durable.scratch_dir(spark, "test-slots")
    schema = "user_id long, us long, n long, kind string"
    spark.createDataFrame(events, schema).withColumn("ts", F.timestamp_micros("us")).drop("us").coalesce(1).write.parquet(f"{path}/in/a")
    raw = runner.file_stream(spark, f"{path}/in/*", spark.read.parquet(f"{path}/in/a").schema).withWatermark("ts", "2 minutes")
    pairs = pairing.pair_sessions(raw, "user_id", "n", "ts", F.col("kind") == "start", F.col("kind") == "stop", 30, slots=3)
    with runner.settings(spark, runner.STATE_STORE):
        last = runner.append_to(pairs, f"{path}/out", f"{path}/checkpoint")
    mark = events[-1][1] - 120 * second
    got = sorted(str(tuple(r)) for r in spark.read.parquet(f"{path}/out").select(
        "user_id", "start_id", "start_us", "stop_id", "stop_us", "outcome").collect())
    assert got == _pairs(events, 1800 * second, mark)
    assert last.lastProgress.stateOperators[0].customMetrics["numRegisteredTimers"] <= 3 * 2
