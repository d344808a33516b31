"""Structured Streaming (2.12) on ``events``, each run to the end of the available files.

In append mode a window is final once the watermark (latest event minus the delay) has passed its end.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import quality
from lakeloom.plans import durable
from lakeloom.registry import query
from lakeloom.streaming import jobs, pairing, runner

MARK = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)"


def stream(t, delay="10 minutes", table="events"):
    raw = runner.file_stream(t.spark, t.path(table), t.events.schema)
    return runner.event_time(raw, "ts", delay)


def _slot(seconds: int, shift: int = 0) -> str:
    return f"make_timestamp(((epoch_us(ts) // 1000000 // {seconds}) * {seconds} - {shift}) * 1000000)"


@query("str_01_tumbling_window", f"""
SELECT w::VARCHAR AS window_start, (w + INTERVAL 5 MINUTE)::VARCHAR AS window_end, event_type, count(*) AS n, round(sum(value), 2) AS total
FROM (SELECT *, {_slot(300)} AS w FROM events) WHERE w + INTERVAL 5 MINUTE <= {MARK} GROUP BY ALL
""")
def tumbling(t):
    aggs = {"n": F.count("*"), "total": F.round(F.sum("value"), 2)}
    return runner.append_result(jobs.tumbling(stream(t), "5 minutes", ["event_type"], aggs), "tumbling")


@query("str_02_sliding_window", f"""
SELECT w::VARCHAR AS window_start, (w + INTERVAL 10 MINUTE)::VARCHAR AS window_end, event_type, count(*) AS n
FROM (SELECT *, {_slot(300)} AS w FROM events UNION ALL SELECT *, {_slot(300, 300)} FROM events)
WHERE w + INTERVAL 10 MINUTE <= {MARK} GROUP BY ALL
""")
def sliding(t):
    out = jobs.sliding(stream(t), "10 minutes", "5 minutes", ["event_type"], {"n": F.count("*")})
    return runner.append_result(out, "sliding")


@query("str_03_session_window", f"""
WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS s
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, min(ts)::VARCHAR AS window_start, (max(ts) + INTERVAL 30 MINUTE)::VARCHAR AS window_end, count(*) AS events
FROM n GROUP BY user_id, sid HAVING max(ts) + INTERVAL 30 MINUTE <= {MARK}
""")
def session(t):
    with runner.settings(t.spark, jobs.MERGE_EARLY):
        return runner.append_result(jobs.sessions(stream(t), "30 minutes", "user_id"), "session")


@query("str_04_watermark_late_rows", """
WITH m AS (SELECT min(ts) + to_seconds((epoch(max(ts) - min(ts)) / 2)::BIGINT) AS middle FROM events),
 w AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events, m WHERE ts >= middle GROUP BY 1)
SELECT h::VARCHAR AS window_start, n, true AS late_rows_seen FROM w WHERE h + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)
""")
def late(t):
    """Second half of the data first: the early half is then late, is counted and changes no window, also not the one that both halves share."""
    root = durable.scratch_dir(t.spark, "late")
    ev = t.events
    half = ev.agg(F.expr("timestampadd(SECOND, cast(round(timestampdiff(MICROSECOND, min(ts), max(ts)) / 2e6) AS INT), min(ts))"))
    ev.filter(F.col("ts") >= half.scalar()).write.parquet(f"{root}/in/a")
    raw = runner.file_stream(t.spark, f"{root}/in/*", ev.schema)
    out = jobs.tumbling(runner.event_time(raw, "ts", "10 minutes"), "1 hour", [], {"n": F.count("*")})
    runner.append_to(out, f"{root}/out", f"{root}/checkpoint")
    ev.filter(F.col("ts") < half.scalar()).write.parquet(f"{root}/in/b")
    second = runner.append_to(out, f"{root}/out", f"{root}/checkpoint")
    dropped = runner.progress_table(t.spark, second).agg(F.sum("late_rows") > 0)
    windows = t.spark.read.schema(out.schema).parquet(f"{root}/out")
    return windows.select("window_start", "n", dropped.scalar().alias("late_rows_seen"))


COUNTS = "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1"


def _counts(t):
    return stream(t).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("str_05_output_mode_update", COUNTS)
def update(t):
    return runner.mode_result(_counts(t), "update", "update", ["event_type"])


@query("str_05_output_mode_complete", COUNTS)
def complete(t):
    return runner.mode_result(_counts(t), "complete", "complete", ["event_type"])


@query("str_06_available_now", "SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'")
def available_now(t):
    return runner.append_result(stream(t).filter("event_type <> 'error'").select("event_id", "event_type", "value"), "now")


@query("str_06b_processing_time", """
SELECT (event_id % 6) // 2 AS batch, count(*) AS input_rows, round(sum(value), 2) AS total FROM events GROUP BY 1
""")
def processing_time(t):
    """Six files, two a micro-batch, a micro-batch a second: rows per batch from the progress, their values from what was written."""
    root = durable.scratch_dir(t.spark, "clock")
    for part in range(6):
        t.events.filter(F.col("event_id") % 6 == part).coalesce(1).write.parquet(f"{root}/in/{part}")
    raw = runner.file_stream(t.spark, f"{root}/in/*", t.events.schema, max_files=2)
    ran = runner.append_by_clock(raw.select("event_id", "value"), f"{root}/out", f"{root}/checkpoint", "1 second")
    batches = runner.progress_table(t.spark, ran).filter("input_rows > 0").select(F.col("batch_id").alias("batch"), "input_rows")
    written = t.spark.read.schema("event_id long, value double").parquet(f"{root}/out")
    totals = written.groupBy(F.floor(F.col("event_id") % 6 / 2).alias("batch")).agg(F.round(F.sum("value"), 2).alias("total"))
    return batches.join(totals, "batch")


@query("str_07_stream_static_join", """
SELECT event_id, user_id, c_mktsegment, n_name FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def static_join(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name")
    out = stream(t).join(people, F.col("user_id") == F.col("c_custkey"), "left")
    return runner.append_result(out.select("event_id", "user_id", "c_mktsegment", "n_name"), "static")


def _sides(t):
    base = runner.file_stream(t.spark, t.path("events"), t.events.schema)
    left = base.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("impression_id"), F.col("ts").alias("impression_time"))
    right = base.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_time"))
    return runner.event_time(left, "impression_time", "2 hours"), runner.event_time(right, "click_time", "3 hours")


@query("str_08_stream_stream_interval_join", """
SELECT i.event_id AS impression_id, c.event_id AS click_id FROM (FROM events WHERE event_type = 'view') i
JOIN (FROM events WHERE event_type = 'click') c ON i.user_id = c.user_id AND c.ts >= i.ts AND c.ts <= i.ts + INTERVAL 1 HOUR
""")
def interval_inner(t):
    out = jobs.interval_join(*_sides(t), "user_id", "impression_time", "click_time", 1, "inner")
    return runner.append_result(out.select("impression_id", "click_id"), "interval")


OUTER_END = "INTERVAL 2 HOUR"  # how far behind the watermark every impression is decided: the hour it may wait, and an hour's slot


@query("str_08b_stream_stream_left_outer", f"""
WITH m AS (SELECT least((SELECT max(ts) - INTERVAL 2 HOUR FROM events WHERE event_type = 'view'),
  (SELECT max(ts) - INTERVAL 3 HOUR FROM events WHERE event_type = 'click')) - {OUTER_END} AS mark)
SELECT i.event_id AS impression_id, c.event_id AS click_id FROM (FROM events, m WHERE event_type = 'view' AND ts < mark) i
LEFT JOIN (FROM events WHERE event_type = 'click') c ON i.user_id = c.user_id AND c.ts >= i.ts AND c.ts <= i.ts + INTERVAL 1 HOUR
""")
def interval_outer(t):
    """Impressions that the watermark has decided, with their clicks or without one."""
    left, right = _sides(t)
    joined = jobs.interval_join(left, right, "user_id", "impression_time", "click_time", 1)
    out = runner.append_result(joined.select("impression_id", "impression_time", "click_id"), "outer")

    def mark(kind, hours):
        return t.events.filter(F.col("event_type") == kind).agg(F.max("ts")).scalar() - F.expr(f"INTERVAL {hours} HOURS")

    decided = F.least(mark("view", 2), mark("click", 3)) - F.expr(OUTER_END)
    return out.filter(F.col("impression_time") < decided.cast("timestamp")).select("impression_id", "click_id")


@query("str_09_dedup_within_watermark", "SELECT event_id, event_type FROM events")
def dedup(t):
    twice = stream(t).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return runner.append_result(twice.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "event_type"), "dedup")


@query("str_10_foreach_batch_sink", """
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 100) AS big FROM events GROUP BY 1
""")
def foreach_batch(t):
    def write(df, batch, root):
        small = df.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 100).alias("big"))
        small.write.mode("overwrite").parquet(f"{root}/out/b={batch}")

    _, root = runner.each_batch(stream(t), "foreach", write)
    parts = t.spark.read.parquet(f"{root}/out/b=*")
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("big").alias("big"))


@query("str_11_checkpoint_restart", "SELECT event_id, user_id, event_type FROM events")
def restart(t):
    root = durable.scratch_dir(t.spark, "restart")
    odd = F.col("event_id") % 2 == 1
    for turn, part in enumerate((odd, ~odd)):
        t.events.filter(part).write.parquet(f"{root}/in/part{turn}")
        raw = runner.file_stream(t.spark, f"{root}/in/*", t.events.schema)
        runner.append_to(raw.select("event_id", "user_id", "event_type"), f"{root}/out", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/out")


@query("str_12_progress_metrics", "SELECT (SELECT count(*) FROM events) AS input_rows, 0::BIGINT AS late_rows, true AS has_state")
def progress(t):
    root = durable.scratch_dir(t.spark, "progress")
    q = runner.append_to(jobs.tumbling(stream(t), "1 hour", ["event_type"], {"n": F.count("*")}), f"{root}/out", f"{root}/checkpoint")
    p = runner.progress_table(t.spark, q)
    return p.agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"), (F.max("state_rows") > 0).alias("has_state"))


@query("str_13_quality_and_quarantine", """
SELECT 'good' AS side, event_id, '' AS reasons FROM events WHERE value > 5 AND event_type <> 'error'
UNION ALL SELECT 'bad', event_id, concat_ws(',', if(value > 5, NULL, 'big'), if(event_type <> 'error', NULL, 'no_error')) FROM events
WHERE NOT (value > 5 AND event_type <> 'error')
""")
def quarantine(t):
    rules = quality.parse({"big": "value > 5", "no_error": "event_type <> 'error'"})
    good, bad = jobs.split_batches(stream(t), rules, "quality")
    return good.select(F.lit("good").alias("side"), "event_id", F.lit("").alias("reasons")).unionByName(
        bad.select(F.lit("bad").alias("side"), "event_id", F.array_join("violated_rules", ",").alias("reasons")))


@query("str_14_bronze_silver_gold", """
SELECT n_name AS region, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events JOIN customer ON c_custkey = user_id
JOIN nation ON c_nationkey = n_nationkey WHERE value > 1 AND ts > (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2
""")
def medallion(t):
    spark, root = t.spark, durable.scratch_dir(t.spark, "medallion")
    bronze = runner.file_stream(spark, t.path("events"), t.events.schema)
    runner.append_to(bronze, f"{root}/bronze", f"{root}/c1")
    silver = runner.file_stream(spark, f"{root}/bronze", t.events.schema).filter("value > 1")
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("region"))
    silver = silver.join(people, F.col("user_id") == F.col("c_custkey")).select("ts", "region", "event_type", "value")
    runner.append_to(silver, f"{root}/silver", f"{root}/c2")
    last = t.events.agg(F.expr("max(ts) - INTERVAL 1 DAY"))
    gold = runner.file_stream(spark, f"{root}/silver", silver.schema).filter(F.col("ts") > F.lit(last.first()[0]).cast("timestamp_ntz"))
    agg = gold.groupBy("region", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return runner.mode_result(agg, "gold", "complete", ["region", "event_type"])


@query("str_14b_last_hour", """
WITH s AS (SELECT ts, n_name AS region, event_type, value FROM events JOIN customer ON c_custkey = user_id JOIN nation ON c_nationkey = n_nationkey
  WHERE event_type <> 'error' AND value > 1),
 g AS (SELECT region, event_type, count(*) AS n, round(sum(value), 2) AS total FROM s WHERE ts > (SELECT max(ts) - INTERVAL 1 HOUR FROM s) GROUP BY 1, 2)
SELECT g.*, (SELECT count(*) FROM events) AS bronze_rows, (SELECT count(*) FROM events WHERE event_type = 'error') AS missed FROM g
""")
def last_hour(t):
    """Files of raw events through bronze with expectations and hourly silver to gold of the last hour, a few files at a trigger."""
    root = durable.scratch_dir(t.spark, "hours")
    t.events.repartitionByRange(4, "ts").write.parquet(f"{root}/in/raw")
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("region"))
    must = quality.parse({"valid_event_id": "event_id IS NOT NULL", "valid_time": "ts IS NOT NULL"})
    gold, report = jobs.last_hour_medallion(
        runner.file_stream(t.spark, f"{root}/in/*", t.events.schema, max_files=1), must, quality.parse({"no_error": "event_type <> 'error'"}),
        quality.parse({"worth": "value > 1"}), people, F.col("user_id") == F.col("c_custkey"), root)
    counts = report.select(F.struct("rows", "no_error").alias("r")).scalar()
    return gold.withColumns({"bronze_rows": counts["rows"], "missed": counts["no_error"]})


@query("str_15_state_per_key", """
SELECT user_id, count(*) AS events, round(sum(value), 2) AS spent, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS span_sec FROM events GROUP BY 1
""")
def state(t):
    states = runner.mode_result(jobs.user_state(stream(t)), "state", "update", ["user_id", "part"])
    return jobs.merge_user_state(states)


@query("str_15b_open_sessions", """
WITH m AS (SELECT epoch_ms(max(ts) - INTERVAL 10 MINUTE) AS ms FROM events),
 e AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS us FROM events, m WHERE epoch_us(ts) <= ms * 1000),
 s AS (SELECT v.user_id, v.event_id AS start_id, v.us AS start_us, arg_min(c.event_id, (c.us, c.event_id)) AS stop_id, min(c.us) AS stop_us
  FROM (FROM e WHERE event_type = 'view') v LEFT JOIN (FROM e WHERE event_type = 'click') c
   ON c.user_id = v.user_id AND (c.us, c.event_id) > (v.us, v.event_id) AND c.us <= v.us + 86400000000 GROUP BY ALL)
SELECT user_id, start_id, start_us, stop_id, stop_us, if(stop_id IS NULL, 'timed out', 'closed') AS outcome FROM s, m
WHERE stop_id IS NOT NULL OR start_us + 86400000000 <= ms * 1000
""")
def open_sessions(t):
    """A view opens a session, the user's next click closes it, a day without one ends it; what the watermark has not passed stays open."""
    pairs = pairing.pair_sessions(
        stream(t), "user_id", "event_id", "ts", F.col("event_type") == "view", F.col("event_type") == "click", 24 * 60)
    with runner.settings(t.spark, runner.STATE_STORE):
        return runner.append_result(pairs, "pairing")


@query("cdc_15_streaming_upsert", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1
""")
def upsert(t):
    return jobs.upsert_batches(stream(t), ["user_id"], ["ts", "event_id"], "upsert").select("user_id", "event_id", "event_type")
