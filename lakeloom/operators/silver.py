"""Device telemetry, raw to cleaned tables.

Each function takes the raw table and the cleaned device master. Raw records arrive more than once,
carry unknown devices and free-hand spellings; a cleaned table holds one row per event of a known
device. Functions ending in ``_checked`` return every cleaned row; the matching entry of ``RULES``
splits them into valid and quarantined rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import conditional as C
from lakeloom.functions.literals import exact_mean, half_up
from lakeloom.operators.aggregates import time_floor
from lakeloom.plans import durable, ordered, skew

# Codes, keywords, steps and limits of the cleaned tables.
REGION_COUNTRY = {
    "US": "United States", "KR": "South Korea", "EU": "Europe", "JP": "Japan",
    "CN": "China", "IN": "India", "BR": "Brazil", "UK": "United Kingdom",
}
SEVERITY = {
    "CRITICAL": ["CRITICAL", "FATAL"], "ERROR": ["ERROR", "ERR"],
    "WARNING": ["WARNING", "WARN"], "INFO": ["INFO", "NOTICE"],
}
ERROR_CATEGORY = [
    ("web_runtime", ["WEB", "BROWSER", "JS"]), ("media", ["MEDIA", "VIDEO", "AUDIO"]),
    ("system", ["KERNEL", "SYSTEM", "INIT"]), ("app", ["APP", "LUNA"]), ("network", ["NETWORK", "WIFI", "NET"]),
]
AD_STEPS = {
    "AD_REQUEST": 1, "AD_IMPRESSION": 2, "AD_START": 3, "FIRST_QUARTILE": 4, "MIDPOINT": 5,
    "THIRD_QUARTILE": 6, "AD_COMPLETE": 7, "AD_CLICK": 8, "AD_SKIP": 9,
}
AD_PROGRESS = {"AD_START": 0.0, "FIRST_QUARTILE": 25.0, "MIDPOINT": 50.0, "THIRD_QUARTILE": 75.0, "AD_COMPLETE": 100.0}
BARE_AD_EVENTS = ["REQUEST", "IMPRESSION", "START", "COMPLETE", "CLICK", "SKIP"]
SESSION_LIMITS = [(60, "zap"), (600, "short"), (3600, "medium")]
APP_LIMITS = [(10, "bounce"), (300, "short"), (1800, "medium")]
BITRATE_LIMITS = [(15000, "4K"), (5000, "FHD"), (2500, "HD")]
BOOT_LIMITS = [(5000, "fast"), (15000, "normal"), (30000, "slow")]
SIGNAL_LIMITS = [(-50, "excellent"), (-60, "good"), (-70, "fair"), (-80, "weak")]
CONFIDENCE_LIMITS = [(0.9, "high"), (0.7, "medium")]
VOICE_LIMITS = [(0.9, "high"), (0.7, "medium"), (0.5, "low")]
PANEL_HEAT = [(60, "critical"), (50, "warning")]
PANEL_AGE = [(30000, "end_of_life"), (20000, "aging"), (10000, "mature")]
POWER_ON, POWER_OFF = ["POWER_ON", "COLD_BOOT", "WARM_BOOT"], ["POWER_OFF", "STANDBY", "SHUTDOWN"]
PLAY, STOP = ["START", "PLAY"], ["STOP", "PAUSE", "END"]
COMMAND, ACK = ["COMMAND", "REQUEST"], ["ACK", "RESPONSE", "RESULT"]
INSTALL_FAILED, INSTALL_DONE = ["FAILED", "ERROR", "TIMEOUT", "ABORTED"], ["SUCCESS", "COMPLETED"]

ROWS_PER_PART = 250_000

RULES = {
    "viewing_sessions": {
        "valid_duration": "duration_sec BETWEEN 0 AND 86400",
        "valid_session": "session_end >= session_start",
    },
    "system_metrics": {"valid_cpu": "avg_cpu_pct BETWEEN 0 AND 100"},
    "ad_funnel": {"valid_sequence": "is_sequence_valid"},
    "streaming_quality": {"valid_latency": "latency_ms > 0"},
    "error_events": {"valid_severity": "severity IN ('CRITICAL', 'ERROR', 'WARNING')"},
}


def _once(raw: DataFrame, known: DataFrame) -> DataFrame:
    """One record per event (the latest), of known devices only."""
    mine = raw.join(known.select("device_id"), "device_id", "left_semi").select(*raw.columns)
    return skew.latest_per_key(mine, ["event_id"], [F.desc("ts")])


def _day(ts: str = "ts") -> Column:
    return F.to_date(ts).alias("event_date")


def _seconds(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _next(df: DataFrame, kind: str, *extra_keys: str) -> DataFrame:
    """Kind and time of the next event of the device (and extra keys)."""
    outputs = {"next_kind": F.col(kind), "next_ts": F.col("ts")}
    keys = ["device_id", *extra_keys]
    return ordered.neighbor(df, keys, ["ts", "event_id"], ordered.day_bucket("ts"), outputs, forward=True)


def _paired(kind: str, opens: list[str], closes: list[str]) -> Column:
    return F.coalesce(F.col(kind).isin(*opens) & F.col("next_kind").isin(*closes), F.lit(False))


def _gap(paired: Column) -> Column:
    return F.when(paired, _seconds("next_ts") - _seconds("ts"))


def devices_cleaned(raw: DataFrame) -> DataFrame:
    region = F.upper(F.trim("region"))
    names = F.create_map(*[F.lit(x) for kv in REGION_COUNTRY.items() for x in kv])
    one = skew.latest_per_key(raw, ["device_id"], [F.desc("manufacturing_date"), F.asc("os_version")])
    return one.withColumns({"region": region, "country": F.coalesce(names[region], F.trim("region"))})


def viewing_sessions_checked(raw: DataFrame, known: DataFrame) -> DataFrame:
    hour = F.hour("session_start")
    fallback = F.when(F.col("app_id").isNotNull(), F.concat(F.lit("App:"), "app_id")).otherwise("Unknown")
    return _once(raw, known).select(
        "event_id", "device_id", "session_start", "session_end", "duration_sec",
        half_up(F.col("duration_sec") / 60.0, 1).alias("duration_min"), "content_source", "app_id", "channel_name",
        "broadcast_type", C.blank_to(F.col("program_title"), fallback).alias("program_title"), "genre", "resolution",
        C.blank_to(F.col("hdr_type"), "SDR").alias("hdr_type"), hour.cast("bigint").alias("viewing_hour"),
        hour.between(19, 23).alias("is_primetime"),
        C.band_below(F.col("duration_sec"), SESSION_LIMITS, "long").alias("viewing_category"), _day("session_start"))


def system_metrics_checked(raw: DataFrame, known: DataFrame) -> DataFrame:
    # a slot's rows meet once, for both steps, in as many parts as keep what a task groups small
    parts = max(raw.sparkSession.sparkContext.defaultParallelism, -(-raw.count() // ROWS_PER_PART))
    mine = raw.join(known.select("device_id"), "device_id", "left_semi").withColumn("slot", time_floor("ts", 300))
    mine = mine.repartition(parts, "device_id", "slot").dropDuplicates(["device_id", "ts", "slot"])
    clean = mine.select(
        "device_id", "slot",
        *[C.clip(F.col(c), 0, 100).alias(c) for c in ("cpu_usage_pct", "mem_used_pct", "gpu_usage_pct")],
        *[C.null_outside(F.col(c), 0, 100).alias(c) for c in ("thermal_zone_0_c", "thermal_zone_1_c")],
        "mem_total_kb", "mem_available_kb", "swap_used_kb", "thermal_throttle_active", "storage_available_mb",
        "process_count", "network_rx_bytes", "network_tx_bytes")
    cpu, mem, heat = F.max("cpu_usage_pct"), F.max("mem_used_pct"), F.max("thermal_zone_0_c")

    def mean(c):
        return half_up(exact_mean(c, 1), 1)

    status = (F.when((cpu > 80) & (mem > 85), "critical")
              .when((cpu > 70) | (mem > 80) | (F.coalesce(heat, F.lit(0.0)) > 70), "warning").otherwise("normal"))
    out = clean.groupBy("device_id", F.col("slot").alias("ts")).agg(
        mean("cpu_usage_pct").alias("avg_cpu_pct"), cpu.alias("max_cpu_pct"),
        mean("mem_used_pct").alias("avg_mem_used_pct"), mem.alias("max_mem_used_pct"),
        F.max("mem_total_kb").alias("mem_total_kb"), F.min("mem_available_kb").alias("min_mem_available_kb"),
        F.max("swap_used_kb").alias("max_swap_used_kb"), mean("gpu_usage_pct").alias("avg_gpu_pct"),
        F.max("gpu_usage_pct").alias("max_gpu_pct"), heat.alias("peak_thermal_0_c"),
        F.max("thermal_zone_1_c").alias("peak_thermal_1_c"), F.bool_or("thermal_throttle_active").alias("any_thermal_throttle"),
        F.min("storage_available_mb").alias("min_storage_available_mb"), F.max("process_count").alias("max_process_count"),
        F.sum("network_rx_bytes").alias("total_rx_bytes"), F.sum("network_tx_bytes").alias("total_tx_bytes"),
        F.count("*").alias("sample_count"), status.alias("health_status"))
    return out.withColumn("event_date", F.to_date("ts"))


def ad_funnel_checked(raw: DataFrame, known: DataFrame) -> DataFrame:
    kind = F.upper("ad_event")
    kind = F.when(kind.isin(*BARE_AD_EVENTS), F.concat(F.lit("AD_"), kind)).otherwise(kind)
    steps = F.create_map(*[F.lit(x) for kv in AD_STEPS.items() for x in kv])
    progress = F.create_map(*[F.lit(x) for kv in AD_PROGRESS.items() for x in kv])
    base = _once(raw, known).withColumn("ad_event", kind)
    base = base.withColumn("vast_order", F.coalesce(steps[F.col("ad_event")], F.lit(0)).cast("bigint"))
    keys = ["device_id", "campaign_id", "ad_unit_id"]
    seen = ordered.neighbor(base, keys, ["ts", "event_id"], ordered.day_bucket("ts"), {"prev": F.col("vast_order")})
    return seen.select(
        "event_id", "device_id", "ts", "ad_event", "ad_unit_id", "campaign_id", "advertiser_name", "ad_format", "placement",
        F.coalesce(F.col("completion_pct").cast("double"), progress[F.col("ad_event")]).alias("completion_pct"), "bid_price_usd",
        "vast_order", F.coalesce(F.col("vast_order") >= F.col("prev"), F.lit(True)).alias("is_sequence_valid"),
        (F.col("ad_event") == "AD_COMPLETE").alias("is_completed"), (F.col("ad_event") == "AD_CLICK").alias("is_clicked"),
        (F.col("ad_event") == "AD_SKIP").alias("is_skipped"), _day())


def streaming_quality_checked(raw: DataFrame, known: DataFrame) -> DataFrame:
    now, target = F.col("current_bitrate_kbps"), F.col("target_bitrate_kbps")
    stall, buffer = F.col("stall_duration_total_ms"), F.col("buffer_duration_ms")
    return _once(raw, known).select(
        "event_id", "device_id", "ts", "stream_event", "app_id", "buffer_duration_ms", "stall_count",
        "stall_duration_total_ms", "current_bitrate_kbps", "target_bitrate_kbps",
        C.blank_to(F.col("cdn_host"), "local_playback").alias("cdn_host"), "latency_ms",
        C.band_from(now, BITRATE_LIMITS, "SD").alias("quality_tier"), C.holds(F.col("latency_ms") > 10000).alias("is_outlier"),
        (C.contains_any(F.col("stream_event"), ["BUFFER"]) | C.holds(F.col("stall_count") > 0)).alias("is_buffering"),
        C.holds((target > 0) & (now < target * 0.5)).alias("is_quality_degraded"),
        F.when((buffer > 0) & stall.isNotNull(), half_up(stall * F.lit(100.0) / buffer, 2)).otherwise(0.0).alias("stall_ratio_pct"),
        _day())


def error_events_checked(raw: DataFrame, known: DataFrame) -> DataFrame:
    process = F.col("process_name")
    about = known.select("device_id", "product_line", "model_name", "manufacturing_date")
    return _once(raw, known).join(about, "device_id").select(
        "event_id", "device_id", "ts", "error_event", C.standardize(F.col("severity"), SEVERITY).alias("severity"),
        "process_name", "crash_signal", "error_code", "error_detail", "product_line", "model_name",
        (C.contains_any(F.col("error_detail"), ["OUT OF MEMORY", "OOM"]) | C.contains_any(F.col("crash_signal"), ["OOM"])).alias("is_oom"),
        (C.contains_any(F.col("error_event"), ["CRASH"]) | F.col("crash_signal").isNotNull()).alias("is_crash"),
        (C.contains_any(process, ["MEDIA", "VIDEO", "AUDIO"]) | C.contains_any(F.col("error_code"), ["MEDIA"])).alias("is_media_error"),
        C.keyword_category(process, ERROR_CATEGORY, "other").alias("error_category"),
        F.datediff(F.to_date("ts"), "manufacturing_date").cast("bigint").alias("device_age_days"), _day())


def app_sessions(raw: DataFrame, known: DataFrame) -> DataFrame:
    sec = F.col("session_duration_sec")
    sane = raw.filter(sec.between(0, 86400) & (F.col("launch_time_ms") >= 0))
    return _once(sane, known).select(
        "event_id", "device_id", F.col("ts").alias("session_start"),
        (F.col("ts") + F.expr("make_dt_interval(0, 0, 0, session_duration_sec)")).alias("session_end"), "app_id", "launch_mode",
        "launch_time_ms", "session_duration_sec", half_up(sec / 60.0, 1).alias("session_duration_min"),
        half_up(F.col("memory_at_launch_kb") / 1024.0, 1).alias("memory_at_launch_mb"),
        C.band_below(sec, APP_LIMITS, "long").alias("session_category"), _day())


def boot_events(raw: DataFrame, known: DataFrame) -> DataFrame:
    return _next(_once(raw, known), "boot_event").select(
        "event_id", "device_id", "ts", "boot_event", "boot_reason", "boot_time_ms", "previous_shutdown",
        half_up(F.col("uptime_before_event_sec") / 3600.0, 1).alias("uptime_before_event_hr"),
        C.band_below(F.col("boot_time_ms"), BOOT_LIMITS, "very_slow").alias("boot_speed_tier"),
        _paired("boot_event", POWER_ON, POWER_OFF).alias("has_matching_off"), _day())


def media_sessions(raw: DataFrame, known: DataFrame) -> DataFrame:
    paired = _paired("media_event", PLAY, STOP)
    tiers = [("4K", ["2160", "3840"]), ("FHD", ["1080", "1920"]), ("HD", ["720", "1280"])]
    return _next(_once(raw, known), "media_event").select(
        "event_id", "device_id", "ts", "media_event", "video_codec", "resolution",
        C.blank_to(F.col("hdr_type"), "SDR").alias("hdr_type"),
        C.keyword_category(F.col("resolution"), tiers, "SD").alias("quality_tier"), _gap(paired).alias("session_duration_sec"),
        paired.alias("has_matching_stop"), _day())


def network_events(raw: DataFrame, known: DataFrame) -> DataFrame:
    signal = C.as_negative(F.col("signal_strength_dbm"))
    paired = _paired("wifi_event", ["CONNECTED"], ["DISCONNECTED"])
    bands = [(5000, "5GHz"), (2400, "2.4GHz")]
    return _next(_once(raw, known), "wifi_event").select(
        "event_id", "device_id", "ts", "wifi_event", "frequency_mhz", signal.alias("signal_strength_dbm"),
        C.band_from(signal, SIGNAL_LIMITS, "very_weak").alias("signal_quality"), "link_speed_mbps",
        C.band_from(F.col("frequency_mhz"), bands, "unknown").alias("frequency_band"),
        _gap(paired).alias("connection_duration_sec"), paired.alias("has_matching_disconnect"), _day())


def acr_content(raw: DataFrame, known: DataFrame) -> DataFrame:
    sure = _once(raw.filter("match_confidence >= 0.5"), known).withColumn("event_date", F.to_date("ts"))
    best = [F.desc("match_confidence"), F.desc("ts"), F.asc("event_id")]
    one = skew.latest_per_key(sure, ["device_id", "fingerprint_hash", "event_date"], best)
    return one.select(
        "event_id", "device_id", "ts", "fingerprint_hash", "match_confidence",
        C.band_from(F.col("match_confidence"), CONFIDENCE_LIMITS, "low").alias("confidence_tier"), "program_title", "genre",
        "is_ad_break", "event_date")


def voice_interactions(raw: DataFrame, known: DataFrame) -> DataFrame:
    spoken = raw.filter(F.col("transcript").isNotNull() & (F.trim("transcript") != ""))
    return _once(spoken, known).select(
        "event_id", "device_id", "ts", "assistant_type", F.lower(F.trim("transcript")).alias("transcript"), "intent",
        "confidence_score", C.band_from(F.col("confidence_score"), VOICE_LIMITS, "very_low").alias("confidence_tier"),
        "result_status", F.col("result_status").isin(*INSTALL_DONE).alias("is_successful"), _day())


def iot_interactions(raw: DataFrame, known: DataFrame) -> DataFrame:
    quick = raw.filter("response_time_ms <= 30000 OR response_time_ms IS NULL")
    paired = _paired("iot_event", COMMAND, ACK)
    return _next(_once(quick, known), "iot_event", "iot_device_id").select(
        "event_id", "device_id", "ts", "iot_event", "iot_device_id", "response_time_ms", "command_result",
        C.holds(F.col("response_time_ms") > 10000).alias("is_response_outlier"), paired.alias("has_matching_ack"),
        _gap(paired).alias("round_trip_sec"), _day())


def panel_health(raw: DataFrame, known: DataFrame) -> DataFrame:
    kinds = [("OLED", ["OLED"]), ("LCD", ["LCD", "LED"]), ("QNED", ["QNED"])]
    once = _once(raw, known)
    numbered = ordered.position(once, ["device_id"], ["ts", "event_id"], ordered.day_bucket("ts"), "diag_sequence_num")
    return numbered.select(
        "event_id", "device_id", "ts", "panel_type", C.keyword_category(F.col("panel_type"), kinds, "OTHER").alias("panel_category"),
        "panel_total_hours", "result", "panel_temperature_c",
        C.band_above(F.col("panel_temperature_c"), PANEL_HEAT, "normal").alias("thermal_status"),
        C.band_above(F.col("panel_total_hours"), PANEL_AGE, "new").alias("panel_age_tier"), "diag_sequence_num", _day())


def firmware_history(raw: DataFrame, known: DataFrame) -> DataFrame:
    once = durable.cut(_once(raw, known).withColumn("result_code", F.upper("install_result")), "firmware")
    numbered = ordered.scan(
        once, ["device_id"], ["ts", "event_id"], before={"prev_target": F.col("target_version"), "prev_result": F.col("result_code")},
        sums={"update_sequence": F.lit(1).cast("bigint")})
    size, ms = F.col("download_size_bytes"), F.col("download_duration_ms")
    follows = (F.col("current_version") == F.col("prev_target")) & F.col("prev_result").isin(*INSTALL_DONE)
    return numbered.select(
        "event_id", "device_id", "ts", "current_version", "target_version", "download_size_bytes",
        half_up(size / F.lit(1048576.0), 1).alias("download_size_mb"), "download_duration_ms",
        F.when((size > 0) & (ms > 0), half_up(size * F.lit(8.0) / (ms / F.lit(1000.0)) / F.lit(1e6), 2)).alias("download_speed_mbps"),
        "install_result", F.col("result_code").isin(*INSTALL_FAILED).alias("is_failed"),
        ((F.col("update_sequence") == 1) | C.holds(follows)).alias("is_sequence_consistent"), "update_sequence", _day())
