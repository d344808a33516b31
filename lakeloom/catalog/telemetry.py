"""Device telemetry (2.18): 15 cleaned tables, their quarantines and 6 summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.catalog import _telemetry_sql as S
from lakeloom.catalog._sql import emean, esum, hu
from lakeloom.functions.literals import exact_mean, exact_sum, half_up, ntz
from lakeloom.operators import gold, quality, silver
from lakeloom.plans import durable
from lakeloom.registry import query
from lakeloom.sources import bronze

# cleaned table -> (number, raw table, function)
CLEANED = {
    "viewing_sessions": (1, "viewing_logs", silver.viewing_sessions_checked),
    "system_metrics": (2, "resource_utilization", silver.system_metrics_checked),
    "ad_funnel": (3, "ad_impressions", silver.ad_funnel_checked),
    "streaming_quality": (4, "streaming_buffer_events", silver.streaming_quality_checked),
    "error_events": (5, "error_crash_events", silver.error_events_checked),
    "app_sessions": (7, "app_launch_events", silver.app_sessions),
    "boot_events": (8, "system_boot_events", silver.boot_events),
    "media_sessions": (9, "media_playback_events", silver.media_sessions),
    "network_events": (10, "wifi_connection_events", silver.network_events),
    "acr_content": (11, "acr_events", silver.acr_content),
    "voice_interactions": (12, "voice_command_events", silver.voice_interactions),
    "iot_interactions": (13, "iot_device_events", silver.iot_interactions),
    "panel_health": (14, "panel_diagnostics", silver.panel_health),
    "firmware_history": (15, "firmware_updates", silver.firmware_history),
}
TIMES = ("ts", "session_start", "session_end", "event_date", "manufacturing_date")


def devices(t):
    return silver.devices_cleaned(bronze.devices(t.customer))


def everything(t, name, known=None):
    _, raw, clean = CLEANED[name]
    return clean(bronze.telemetry(t.spread("events", "event_id"), raw), devices(t) if known is None else known)


def cleaned(t, name, known=None):
    rules = silver.RULES.get(name)
    df = everything(t, name, known)
    return quality.drop_bad(df, quality.parse(rules)) if rules else df


def _texts(sql: str, cols: list[str]) -> str:
    shown = ", ".join(f"{c}::VARCHAR AS {c}" for c in cols)
    return f"SELECT * REPLACE ({shown}) FROM {sql}"


def _time_columns(name: str) -> list[str]:
    own = {"viewing_sessions": ["session_start", "session_end"], "app_sessions": ["session_start", "session_end"]}
    return [*own.get(name, ["ts"]), "event_date"]


for _name, (_no, _raw, _fn) in CLEANED.items():
    query(f"slv_{_no:02d}_{_name}", _texts(S.TABLES[_name], _time_columns(_name)))(lambda t, n=_name: cleaned(t, n))

query("slv_06_devices_cleaned", _texts(S.DEVICES, ["manufacturing_date"]))(devices)


def _quarantined(t, name):
    _, bad = quality.quarantine(everything(t, name), quality.parse(silver.RULES[name]), ntz("2024-02-01"))
    return bad.select("event_id", "first_rule", "violated_rules", "event_date")


QUARANTINE_SQL = {
    "viewing_sessions": (S.VIEWING_ALL, {"valid_duration": "duration_sec BETWEEN 0 AND 86400", "valid_session": "session_end >= session_start"}),
    "ad_funnel": (S.ADS_ALL, {"valid_sequence": "is_sequence_valid"}),
    "streaming_quality": (S.STREAMS_ALL, {"valid_latency": "latency_ms > 0"}),
    "error_events": (S.ERRORS_ALL, {"valid_severity": "severity IN ('CRITICAL','ERROR','WARNING')"}),
}
for _name, (_all, _rules) in QUARANTINE_SQL.items():
    _tests = ", ".join(f"if({p}, NULL, '{n}')" for n, p in _rules.items())
    _sql = (f"SELECT event_id, coalesce({_tests}) AS first_rule, concat_ws(',', {_tests}) AS violated_rules,"
            f" event_date::VARCHAR AS event_date FROM {_all} WHERE NOT ({' AND '.join(_rules.values())})")
    query(f"slv_{CLEANED[_name][0]:02d}q_{_name}_quarantine", _sql)(lambda t, n=_name: _quarantined(t, n))


@query("slv_02q_system_metrics_quarantine", f"SELECT 'valid_cpu' AS rule, count(*) AS passed, 0 AS failed FROM {S.METRICS_ALL}")
def metrics_quarantine(t):
    """Clipping keeps every average in range, so the quarantine is empty and only its report is shown."""
    return quality.report(everything(t, "system_metrics"), quality.parse(silver.RULES["system_metrics"]))


query("gld_01_daily_viewing_summary", S.GOLD["daily_viewing_summary"])(
    lambda t: gold.daily_viewing_summary(cleaned(t, "viewing_sessions"), devices(t)))
query("gld_02_content_popularity", S.GOLD["content_popularity"])(
    lambda t: gold.content_popularity(cleaned(t, "viewing_sessions"), devices(t)))
query("gld_03_ad_campaign_kpi", S.GOLD["ad_campaign_kpi"])(lambda t: gold.ad_campaign_kpi(cleaned(t, "ad_funnel")))
query("gld_04_device_health_score", S.GOLD["device_health_score"])(
    lambda t: gold.device_health_score(*[cleaned(t, n) for n in ("system_metrics", "error_events", "boot_events")], devices(t)))
query("gld_05_streaming_qoe", S.GOLD["streaming_qoe"])(
    lambda t: gold.streaming_qoe(cleaned(t, "streaming_quality"), devices(t)))


@query("gld_06_user_engagement_360", S.GOLD["user_engagement_360"])
def engagement(t):
    """The devices and the viewing sessions are used several times and written first."""
    known = durable.cut(devices(t), "devices")
    viewing = durable.cut(cleaned(t, "viewing_sessions", known), "viewing")
    switches = bronze.telemetry(t.spread("events", "event_id"), "input_switch_events").withColumn("event_date", F.to_date("ts"))
    voice, iot, streams, errors, ads = (
        cleaned(t, n, known) for n in ("voice_interactions", "iot_interactions", "streaming_quality", "error_events", "ad_funnel"))
    return gold.user_engagement_360(known, viewing, voice, iot, switches, streams, errors, ads)


_RECENT = "event_date > (SELECT max(event_date) FROM d) - {days}"
GOLD_QUESTIONS = f"""
WITH d AS (SELECT * REPLACE (event_date::DATE AS event_date) FROM ({S.GOLD["daily_viewing_summary"]})),
 c AS (SELECT * REPLACE (event_date::DATE AS event_date) FROM ({S.GOLD["content_popularity"]})),
 top AS (SELECT program_title, sum(total_viewers) AS viewers FROM c WHERE event_date > (SELECT max(event_date) FROM c) - 7 AND program_title <> 'Unknown'
  GROUP BY 1 ORDER BY viewers DESC, program_title LIMIT 10),
 w AS (SELECT date_trunc('week', event_date)::DATE AS week, {emean("total_viewing_min", 1)} AS mean FROM d WHERE {_RECENT.format(days=30)} GROUP BY 1),
 g AS (SELECT week, mean, lag(mean) OVER (ORDER BY week) AS before FROM w)
SELECT 'top_programs' AS question, program_title AS item, viewers::DOUBLE AS result FROM top
UNION ALL SELECT 'ott_share_by_region', region, {hu(f"{esum('ott_min', 1)} * 100.0::DOUBLE / nullif({esum('ott_min', 1)} + {esum('live_tv_min', 1)}, 0)", 1)} FROM d GROUP BY 2
UNION ALL SELECT 'minutes_by_day_kind', CASE WHEN dayofweek(event_date) IN (0, 6) THEN 'weekend' ELSE 'weekday' END, {hu(emean("total_viewing_min", 1), 1)} FROM d GROUP BY 2
UNION ALL SELECT 'primetime_viewers_by_day', dayname(event_date), count(DISTINCT device_id)::DOUBLE FROM d WHERE primetime_min > 0 AND {_RECENT.format(days=30)} GROUP BY 2
UNION ALL SELECT 'minutes_by_model', model_name, {hu(emean("total_viewing_min", 1), 1)} FROM d JOIN {S.DEVICES} m USING (device_id) GROUP BY 2
UNION ALL SELECT 'week_over_week_pct', week::VARCHAR, {hu("(mean - before) * 100.0::DOUBLE / before", 1)} FROM g
"""


@query("met_14b_gold_questions", GOLD_QUESTIONS)
def gold_questions(t):
    """Six questions over the gold tables: programs, sources by region, kinds of day, primetime, device models and week over week."""
    known = durable.cut(devices(t), "devices")
    viewing = durable.cut(cleaned(t, "viewing_sessions", known), "viewing")
    daily = durable.cut(gold.daily_viewing_summary(viewing, known), "daily")
    content = gold.content_popularity(viewing, known)
    minutes = exact_mean("total_viewing_min", 1)

    def recent(df, days):
        return df.filter(F.col("event_date") > F.date_sub(df.agg(F.max("event_date")).scalar(), days))

    programs = recent(content, 7).filter("program_title <> 'Unknown'").groupBy(F.col("program_title").alias("item")).agg(F.sum("total_viewers").alias("v"))
    ott, live = exact_sum("ott_min", 1), exact_sum("live_tv_min", 1)
    kind = F.when(F.dayofweek("event_date").isin(1, 7), "weekend").otherwise("weekday")
    weekly = recent(daily, 30).groupBy(F.date_trunc("week", "event_date").alias("week")).agg(minutes.alias("mean"))
    before = F.lag("mean").over(W.orderBy("week"))  # one row per week of a month
    answers = {
        "top_programs": programs.orderBy(F.desc("v"), "item").limit(10).select("item", F.col("v").cast("double").alias("result")),
        "ott_share_by_region": daily.groupBy(F.col("region").alias("item")).agg(half_up(F.try_divide(ott * 100.0, ott + live), 1).alias("result")),
        "minutes_by_day_kind": daily.groupBy(kind.alias("item")).agg(half_up(minutes, 1).alias("result")),
        "primetime_viewers_by_day": recent(daily, 30).filter("primetime_min > 0").groupBy(F.date_format("event_date", "EEEE").alias("item")).agg(
            F.count_distinct("device_id").cast("double").alias("result")),
        "minutes_by_model": daily.join(known.select("device_id", "model_name"), "device_id").groupBy(F.col("model_name").alias("item")).agg(
            half_up(minutes, 1).alias("result")),
        "week_over_week_pct": weekly.select(F.to_date("week").cast("string").alias("item"), half_up((F.col("mean") - before) * 100.0 / before, 1).alias("result")),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(q).alias("question"), "item", "result") for q, df in answers.items()])
