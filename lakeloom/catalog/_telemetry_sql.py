"""Oracle texts of the telemetry tables, composed bottom-up from the raw builders."""

from __future__ import annotations

from lakeloom.catalog._sql import emean, esum, hu
from lakeloom.sources import bronze

DEVICES = f"""(SELECT * REPLACE (upper(trim(region)) AS region), coalesce(map {{'US': 'United States', 'KR': 'South Korea',
 'EU': 'Europe', 'JP': 'Japan', 'CN': 'China', 'IN': 'India', 'BR': 'Brazil', 'UK': 'United Kingdom'}}[upper(trim(region))], trim(region)) AS country
 FROM ({bronze.oracle_cte("devices")}) QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY manufacturing_date DESC, os_version) = 1)"""


def raw(table: str) -> str:
    """Distinct raw records of known devices; the planted copies are identical."""
    return f"(SELECT DISTINCT * FROM ({bronze.oracle_cte(table)}) WHERE device_id IN (SELECT device_id FROM {DEVICES}))"


def has(col: str, *words: str) -> str:
    return "coalesce(" + " OR ".join(f"contains(upper({col}), '{w}')" for w in words) + ", false)"


def sec(ts: str) -> str:
    return f"epoch(date_trunc('second', {ts}))::BIGINT"


def pair(kind: str, opens: str, closes: str, keys: str = "device_id") -> tuple[str, str, str]:
    w = f"WINDOW w AS (PARTITION BY {keys} ORDER BY ts, event_id)"
    test = f"coalesce({kind} IN ({opens}) AND lead({kind}) OVER w IN ({closes}), false)"
    return test, f"CASE WHEN {test} THEN {sec('lead(ts) OVER w')} - {sec('ts')} END", w


POWER, PLAY, WIFI, IOT = (
    pair("boot_event", "'POWER_ON','COLD_BOOT','WARM_BOOT'", "'POWER_OFF','STANDBY','SHUTDOWN'"),
    pair("media_event", "'START','PLAY'", "'STOP','PAUSE','END'"),
    pair("wifi_event", "'CONNECTED'", "'DISCONNECTED'"),
    pair("iot_event", "'COMMAND','REQUEST'", "'ACK','RESPONSE','RESULT'", "device_id, iot_device_id"),
)
DAY = "ts::DATE AS event_date"

VIEWING_ALL = f"""(SELECT event_id, device_id, session_start, session_end, duration_sec, {hu("duration_sec / 60.0::DOUBLE", 1)} AS duration_min,
 content_source, app_id, channel_name, broadcast_type,
 coalesce(nullif(trim(program_title), ''), 'App:' || app_id, 'Unknown') AS program_title, genre, resolution,
 coalesce(nullif(trim(hdr_type), ''), 'SDR') AS hdr_type, hour(session_start) AS viewing_hour,
 hour(session_start) BETWEEN 19 AND 23 AS is_primetime, CASE WHEN duration_sec < 60 THEN 'zap' WHEN duration_sec < 600 THEN 'short'
 WHEN duration_sec < 3600 THEN 'medium' ELSE 'long' END AS viewing_category, session_start::DATE AS event_date FROM {raw("viewing_logs")})"""
VIEWING_OK = "duration_sec BETWEEN 0 AND 86400 AND session_end >= session_start"
METRICS_ALL = f"""(WITH c AS (SELECT device_id, make_timestamp(({sec("ts")} // 300) * 300 * 1000000) AS ts, greatest(0, least(100, cpu_usage_pct)) AS cpu,
  greatest(0, least(100, mem_used_pct)) AS mem, greatest(0, least(100, gpu_usage_pct)) AS gpu,
  CASE WHEN thermal_zone_0_c BETWEEN 0 AND 100 THEN thermal_zone_0_c END AS t0, CASE WHEN thermal_zone_1_c BETWEEN 0 AND 100 THEN thermal_zone_1_c END AS t1,
  * EXCLUDE (device_id, ts) FROM {raw("resource_utilization")})
 SELECT device_id, ts, {hu(emean("cpu", 1), 1)} AS avg_cpu_pct, max(cpu) AS max_cpu_pct, {hu(emean("mem", 1), 1)} AS avg_mem_used_pct, max(mem) AS max_mem_used_pct,
 max(mem_total_kb) AS mem_total_kb, min(mem_available_kb) AS min_mem_available_kb, max(swap_used_kb) AS max_swap_used_kb, {hu(emean("gpu", 1), 1)} AS avg_gpu_pct,
 max(gpu) AS max_gpu_pct, max(t0) AS peak_thermal_0_c, max(t1) AS peak_thermal_1_c, bool_or(thermal_throttle_active) AS any_thermal_throttle,
 min(storage_available_mb) AS min_storage_available_mb, max(process_count) AS max_process_count, sum(network_rx_bytes)::BIGINT AS total_rx_bytes,
 sum(network_tx_bytes)::BIGINT AS total_tx_bytes, count(*) AS sample_count,
 CASE WHEN max(cpu) > 80 AND max(mem) > 85 THEN 'critical' WHEN max(cpu) > 70 OR max(mem) > 80 OR coalesce(max(t0), 0) > 70 THEN 'warning' ELSE 'normal' END AS health_status,
 ts::DATE AS event_date FROM c GROUP BY device_id, ts)"""
STEP_NAMES = ("AD_REQUEST", "AD_IMPRESSION", "AD_START", "FIRST_QUARTILE", "MIDPOINT", "THIRD_QUARTILE", "AD_COMPLETE", "AD_CLICK", "AD_SKIP")
ADS_ALL = f"""(WITH k AS (SELECT * REPLACE (CASE WHEN upper(ad_event) IN ('REQUEST','IMPRESSION','START','COMPLETE','CLICK','SKIP')
   THEN 'AD_' || upper(ad_event) ELSE upper(ad_event) END AS ad_event) FROM {raw("ad_impressions")}),
  s AS (SELECT *, list_position({list(STEP_NAMES)}, ad_event) AS pos FROM k), o AS (SELECT *, coalesce(pos, 0)::BIGINT AS vast_order FROM s)
 SELECT event_id, device_id, ts, ad_event, ad_unit_id, campaign_id, advertiser_name, ad_format, placement,
 coalesce(completion_pct::DOUBLE, CASE WHEN vast_order BETWEEN 3 AND 7 THEN (vast_order - 3) * 25.0::DOUBLE END) AS completion_pct, bid_price_usd, vast_order,
 coalesce(vast_order >= lag(vast_order) OVER (PARTITION BY device_id, campaign_id, ad_unit_id ORDER BY ts, event_id), true) AS is_sequence_valid,
 ad_event = 'AD_COMPLETE' AS is_completed, ad_event = 'AD_CLICK' AS is_clicked, ad_event = 'AD_SKIP' AS is_skipped, {DAY} FROM o)"""
STREAMS_ALL = f"""(SELECT event_id, device_id, ts, stream_event, app_id, buffer_duration_ms, stall_count, stall_duration_total_ms, current_bitrate_kbps,
 target_bitrate_kbps, coalesce(nullif(trim(cdn_host), ''), 'local_playback') AS cdn_host, latency_ms,
 CASE WHEN current_bitrate_kbps >= 15000 THEN '4K' WHEN current_bitrate_kbps >= 5000 THEN 'FHD' WHEN current_bitrate_kbps >= 2500 THEN 'HD' ELSE 'SD' END AS quality_tier,
 latency_ms > 10000 AS is_outlier, {has("stream_event", "BUFFER")} OR stall_count > 0 AS is_buffering,
 target_bitrate_kbps > 0 AND current_bitrate_kbps < target_bitrate_kbps * 0.5 AS is_quality_degraded,
 CASE WHEN buffer_duration_ms > 0 AND stall_duration_total_ms IS NOT NULL THEN {hu("stall_duration_total_ms * 100.0::DOUBLE / buffer_duration_ms", 2)} ELSE 0.0::DOUBLE END AS stall_ratio_pct,
 {DAY} FROM {raw("streaming_buffer_events")})"""
ERRORS_ALL = f"""(SELECT event_id, e.device_id, ts, error_event, CASE WHEN upper(trim(severity)) IN ('CRITICAL','FATAL') THEN 'CRITICAL'
 WHEN upper(trim(severity)) IN ('ERROR','ERR') THEN 'ERROR' WHEN upper(trim(severity)) IN ('WARNING','WARN') THEN 'WARNING'
 WHEN upper(trim(severity)) IN ('INFO','NOTICE') THEN 'INFO' ELSE 'UNKNOWN' END AS severity, process_name, crash_signal, error_code, error_detail,
 product_line, model_name, {has("error_detail", "OUT OF MEMORY", "OOM")} OR {has("crash_signal", "OOM")} AS is_oom,
 {has("error_event", "CRASH")} OR crash_signal IS NOT NULL AS is_crash,
 {has("process_name", "MEDIA", "VIDEO", "AUDIO")} OR {has("error_code", "MEDIA")} AS is_media_error,
 CASE WHEN {has("process_name", "WEB", "BROWSER", "JS")} THEN 'web_runtime' WHEN {has("process_name", "MEDIA", "VIDEO", "AUDIO")} THEN 'media'
  WHEN {has("process_name", "KERNEL", "SYSTEM", "INIT")} THEN 'system' WHEN {has("process_name", "APP", "LUNA")} THEN 'app'
  WHEN {has("process_name", "NETWORK", "WIFI", "NET")} THEN 'network' ELSE 'other' END AS error_category,
 date_diff('day', manufacturing_date, ts::DATE) AS device_age_days, {DAY}
 FROM {raw("error_crash_events")} e JOIN {DEVICES} d ON d.device_id = e.device_id)"""

TABLES = {
    "devices_cleaned": DEVICES,
    "viewing_sessions": f"(SELECT * FROM {VIEWING_ALL} WHERE {VIEWING_OK})",
    "system_metrics": METRICS_ALL,
    "ad_funnel": f"(SELECT * FROM {ADS_ALL} WHERE is_sequence_valid)",
    "streaming_quality": f"(SELECT * FROM {STREAMS_ALL} WHERE latency_ms > 0)",
    "error_events": f"(SELECT * FROM {ERRORS_ALL} WHERE severity IN ('CRITICAL','ERROR','WARNING'))",
    "app_sessions": f"""(SELECT event_id, device_id, ts AS session_start, ts + to_seconds(session_duration_sec) AS session_end, app_id, launch_mode, launch_time_ms,
 session_duration_sec, {hu("session_duration_sec / 60.0::DOUBLE", 1)} AS session_duration_min, {hu("memory_at_launch_kb / 1024.0::DOUBLE", 1)} AS memory_at_launch_mb,
 CASE WHEN session_duration_sec < 10 THEN 'bounce' WHEN session_duration_sec < 300 THEN 'short' WHEN session_duration_sec < 1800 THEN 'medium' ELSE 'long' END AS session_category,
 {DAY} FROM {raw("app_launch_events")} WHERE session_duration_sec BETWEEN 0 AND 86400 AND launch_time_ms >= 0)""",
    "boot_events": f"""(SELECT event_id, device_id, ts, boot_event, boot_reason, boot_time_ms, previous_shutdown, {hu("uptime_before_event_sec / 3600.0::DOUBLE", 1)} AS uptime_before_event_hr,
 CASE WHEN boot_time_ms < 5000 THEN 'fast' WHEN boot_time_ms < 15000 THEN 'normal' WHEN boot_time_ms < 30000 THEN 'slow' ELSE 'very_slow' END AS boot_speed_tier,
 {POWER[0]} AS has_matching_off, {DAY} FROM {raw("system_boot_events")} {POWER[2]})""",
    "media_sessions": f"""(SELECT event_id, device_id, ts, media_event, video_codec, resolution, coalesce(nullif(trim(hdr_type), ''), 'SDR') AS hdr_type,
 CASE WHEN {has("resolution", "2160", "3840")} THEN '4K' WHEN {has("resolution", "1080", "1920")} THEN 'FHD' WHEN {has("resolution", "720", "1280")} THEN 'HD' ELSE 'SD' END AS quality_tier,
 {PLAY[1]} AS session_duration_sec, {PLAY[0]} AS has_matching_stop, {DAY} FROM {raw("media_playback_events")} {PLAY[2]})""",
    "network_events": f"""(SELECT event_id, device_id, ts, wifi_event, frequency_mhz, -abs(signal_strength_dbm) AS signal_strength_dbm,
 CASE WHEN abs(signal_strength_dbm) <= 50 THEN 'excellent' WHEN abs(signal_strength_dbm) <= 60 THEN 'good' WHEN abs(signal_strength_dbm) <= 70 THEN 'fair'
  WHEN abs(signal_strength_dbm) <= 80 THEN 'weak' ELSE 'very_weak' END AS signal_quality, link_speed_mbps,
 CASE WHEN frequency_mhz >= 5000 THEN '5GHz' WHEN frequency_mhz >= 2400 THEN '2.4GHz' ELSE 'unknown' END AS frequency_band,
 {WIFI[1]} AS connection_duration_sec, {WIFI[0]} AS has_matching_disconnect, {DAY} FROM {raw("wifi_connection_events")} {WIFI[2]})""",
    "acr_content": f"""(SELECT event_id, device_id, ts, fingerprint_hash, match_confidence, CASE WHEN match_confidence >= 0.9 THEN 'high' WHEN match_confidence >= 0.7 THEN 'medium' ELSE 'low' END AS confidence_tier,
 program_title, genre, is_ad_break, {DAY} FROM {raw("acr_events")} WHERE match_confidence >= 0.5
 QUALIFY row_number() OVER (PARTITION BY device_id, fingerprint_hash, ts::DATE ORDER BY match_confidence DESC, ts DESC, event_id) = 1)""",
    "voice_interactions": f"""(SELECT event_id, device_id, ts, assistant_type, lower(trim(transcript)) AS transcript, intent, confidence_score,
 CASE WHEN confidence_score >= 0.9 THEN 'high' WHEN confidence_score >= 0.7 THEN 'medium' WHEN confidence_score >= 0.5 THEN 'low' ELSE 'very_low' END AS confidence_tier,
 result_status, result_status IN ('SUCCESS','COMPLETED') AS is_successful, {DAY} FROM {raw("voice_command_events")} WHERE trim(transcript) <> '')""",
    "iot_interactions": f"""(SELECT event_id, device_id, ts, iot_event, iot_device_id, response_time_ms, command_result, coalesce(response_time_ms > 10000, false) AS is_response_outlier,
 {IOT[0]} AS has_matching_ack, {IOT[1]} AS round_trip_sec, {DAY} FROM (SELECT * FROM {raw("iot_device_events")} WHERE response_time_ms <= 30000 OR response_time_ms IS NULL) {IOT[2]})""",
    "panel_health": f"""(SELECT event_id, device_id, ts, panel_type, CASE WHEN {has("panel_type", "OLED")} THEN 'OLED' WHEN {has("panel_type", "LCD", "LED")} THEN 'LCD'
 WHEN {has("panel_type", "QNED")} THEN 'QNED' ELSE 'OTHER' END AS panel_category, panel_total_hours, result, panel_temperature_c,
 CASE WHEN panel_temperature_c > 60 THEN 'critical' WHEN panel_temperature_c > 50 THEN 'warning' ELSE 'normal' END AS thermal_status,
 CASE WHEN panel_total_hours > 30000 THEN 'end_of_life' WHEN panel_total_hours > 20000 THEN 'aging' WHEN panel_total_hours > 10000 THEN 'mature' ELSE 'new' END AS panel_age_tier,
 row_number() OVER (PARTITION BY device_id ORDER BY ts, event_id) AS diag_sequence_num, {DAY} FROM {raw("panel_diagnostics")})""",
    "firmware_history": f"""(SELECT event_id, device_id, ts, current_version, target_version, download_size_bytes, {hu("download_size_bytes / 1048576.0::DOUBLE", 1)} AS download_size_mb, download_duration_ms,
 CASE WHEN download_size_bytes > 0 AND download_duration_ms > 0 THEN {hu("download_size_bytes * 8.0::DOUBLE / (download_duration_ms / 1000.0::DOUBLE) / 1e6", 2)} END AS download_speed_mbps,
 install_result, upper(install_result) IN ('FAILED','ERROR','TIMEOUT','ABORTED') AS is_failed,
 row_number() OVER w = 1 OR coalesce(current_version = lag(target_version) OVER w AND lag(upper(install_result)) OVER w IN ('SUCCESS','COMPLETED'), false) AS is_sequence_consistent,
 row_number() OVER w AS update_sequence, {DAY} FROM {raw("firmware_updates")} WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id))""",
}


def minutes(test: str) -> str:
    return esum(f"CASE WHEN {test} THEN duration_min ELSE 0.0::DOUBLE END", 1)


def share(test: str) -> str:
    return hu(f"{minutes(test)} * 100.0::DOUBLE / greatest({esum('duration_min', 1)}, 1.0::DOUBLE)", 1)


def pct(test: str, digits: int = 2) -> str:
    return hu(f"count(*) FILTER (WHERE {test}) * 100.0::DOUBLE / count(*)", digits)


V, D, T = TABLES["viewing_sessions"], DEVICES, TABLES
LIVE, OTT = has("content_source", "LIVE", "TV"), has("content_source", "OTT", "STREAM", "APP")

GOLD = {
    "daily_viewing_summary": f"""WITH v AS (FROM {V}), a AS (SELECT device_id, event_date, app_id AS top_app FROM v WHERE app_id IS NOT NULL GROUP BY device_id, event_date, app_id
  QUALIFY row_number() OVER (PARTITION BY device_id, event_date ORDER BY {esum("duration_min", 1)} DESC, app_id) = 1),
 g AS (SELECT device_id, event_date, genre AS top_genre FROM v WHERE genre IS NOT NULL GROUP BY device_id, event_date, genre
  QUALIFY row_number() OVER (PARTITION BY device_id, event_date ORDER BY {esum("duration_min", 1)} DESC, genre) = 1),
 t AS (SELECT device_id, event_date, {hu(esum("duration_min", 1), 1)} AS total_viewing_min, count(*) AS session_count, {hu(emean("duration_min", 1), 1)} AS avg_session_min,
  max(duration_min) AS max_session_min, {hu(minutes(LIVE + " OR " + has("broadcast_type", "LIVE")), 1)} AS live_tv_min, {hu(minutes(OTT), 1)} AS ott_min,
  {hu(minutes(has("content_source", "HDMI", "EXTERNAL")), 1)} AS hdmi_min, count(DISTINCT channel_name) AS unique_channels, {hu(minutes("is_primetime"), 1)} AS primetime_min,
  {share("hdr_type <> 'SDR'")} AS hdr_viewing_pct, {share(has("resolution", "2160", "3840", "4K"))} AS uhd_viewing_pct FROM v GROUP BY 1, 2)
 SELECT * REPLACE (event_date::VARCHAR AS event_date) FROM t LEFT JOIN a USING (device_id, event_date) LEFT JOIN g USING (device_id, event_date)
 JOIN (SELECT device_id, region, product_line, panel_type FROM {D}) USING (device_id)""",
    "content_popularity": f"""WITH v AS (FROM {V}) SELECT program_title, genre, content_source, event_date::VARCHAR AS event_date, count(DISTINCT device_id) AS total_viewers,
 {hu(esum("duration_min", 1), 1)} AS total_viewing_min, {hu(emean("duration_min", 1), 1)} AS avg_viewing_min,
 {hu(emean("least(duration_sec * 100.0::DOUBLE / 1800, 100.0::DOUBLE)", 6), 1)} AS completion_rate,
 {hu("count(DISTINCT device_id) * 100.0::DOUBLE / (SELECT count(DISTINCT device_id) FROM v)", 2)} AS reach_pct FROM v GROUP BY 1, 2, 3, event_date""",
    "ad_campaign_kpi": f"""SELECT campaign_id, advertiser_name, ad_format, placement, event_date::VARCHAR AS event_date, count(*) AS impressions,
 count(*) FILTER (WHERE is_clicked) AS clicks, count(*) FILTER (WHERE is_completed) AS completions, count(*) FILTER (WHERE is_skipped) AS skips,
 count(*) FILTER (WHERE contains(ad_event, 'ERROR')) AS errors, {pct("is_clicked")} AS ctr, {pct("is_completed")} AS vcr, {hu(emean("completion_pct", 1), 1)} AS avg_completion_pct,
 {hu("coalesce(" + esum("bid_price_usd") + ", 0)", 2)} AS total_revenue_usd, {hu("coalesce(" + esum("bid_price_usd") + ", 0) / count(*) * 1000", 2)} AS ecpm,
 count(DISTINCT device_id) AS unique_devices, {hu("count(*) / count(DISTINCT device_id)", 1)} AS frequency FROM {T["ad_funnel"]} GROUP BY 1, 2, 3, 4, event_date""",
    "device_health_score": f"""WITH m AS (SELECT device_id, event_date, {hu(emean("avg_cpu_pct", 1), 1)} AS avg_cpu_pct, {hu(emean("avg_mem_used_pct", 1), 1)} AS avg_mem_pct,
  max(peak_thermal_0_c) AS peak_soc_temp, max(peak_thermal_1_c) AS peak_panel_temp, count(*) FILTER (WHERE any_thermal_throttle) AS throttle_count FROM {T["system_metrics"]} GROUP BY 1, 2),
 e AS (SELECT device_id, event_date, count(*) FILTER (WHERE is_crash) AS crash_count, count(*) FILTER (WHERE is_oom) AS oom_count,
  count(*) FILTER (WHERE is_media_error) AS media_error_count FROM {T["error_events"]} GROUP BY 1, 2),
 b AS (SELECT device_id, event_date, count(*) FILTER (WHERE boot_event IN ('POWER_ON','COLD_BOOT','WARM_BOOT','REBOOT')) AS reboot_count,
  count(*) FILTER (WHERE upper(previous_shutdown) IN ('DIRTY','ABNORMAL','CRASH','WATCHDOG')) AS dirty_shutdown_count FROM {T["boot_events"]} GROUP BY 1, 2),
 k AS (SELECT device_id, event_date FROM m UNION SELECT device_id, event_date FROM e UNION SELECT device_id, event_date FROM b),
 c AS (SELECT device_id, event_date, coalesce(avg_cpu_pct, 0) AS avg_cpu_pct, coalesce(avg_mem_pct, 0) AS avg_mem_pct, peak_soc_temp, peak_panel_temp,
  coalesce(throttle_count, 0) AS throttle_count, coalesce(crash_count, 0) AS crash_count, coalesce(oom_count, 0) AS oom_count,
  coalesce(media_error_count, 0) AS media_error_count, coalesce(reboot_count, 0) AS reboot_count, coalesce(dirty_shutdown_count, 0) AS dirty_shutdown_count
  FROM k LEFT JOIN m USING (device_id, event_date) LEFT JOIN e USING (device_id, event_date) LEFT JOIN b USING (device_id, event_date)),
 s AS (SELECT *, greatest(0, least(100, 100 - crash_count * 10 - oom_count * 8 - throttle_count * 5 - dirty_shutdown_count * 15 - media_error_count * 3
  - if(avg_cpu_pct > 80, 5, 0) - if(coalesce(peak_soc_temp, 0) > 75, 5, 0)))::BIGINT AS health_score FROM c)
 SELECT s.* REPLACE (event_date::VARCHAR AS event_date), CASE WHEN health_score >= 90 THEN 'A' WHEN health_score >= 70 THEN 'B' WHEN health_score >= 50 THEN 'C' WHEN health_score >= 30 THEN 'D' ELSE 'F' END AS health_grade,
 concat_ws(',', if(crash_count >= 3, 'high_crash_rate', NULL), if(oom_count >= 2, 'oom_frequent', NULL), if(throttle_count >= 3, 'thermal_throttle', NULL),
  if(dirty_shutdown_count >= 1, 'dirty_shutdown', NULL), if(avg_cpu_pct > 80, 'high_cpu', NULL), if(peak_soc_temp > 75, 'high_temperature', NULL),
  if(media_error_count >= 3, 'media_errors', NULL)) AS risk_factors, product_line, os_version
 FROM s LEFT JOIN {D} d ON d.device_id = s.device_id""",
    "streaming_qoe": f"""WITH s AS (SELECT q.*, region FROM {T["streaming_quality"]} q JOIN {D} d ON d.device_id = q.device_id),
 a AS (SELECT app_id, region, quality_tier, event_date, count(*) AS total_streams, count(DISTINCT device_id) AS unique_devices,
  {hu(emean("current_bitrate_kbps", 0), 0)} AS avg_bitrate_kbps, {hu(emean("latency_ms", 0), 1)} AS avg_latency_ms, {pct("is_buffering")} AS buffering_rate,
  {emean("stall_count", 0)} AS stalls, {hu(emean("stall_duration_total_ms / 1000.0::DOUBLE", 3), 2)} AS avg_stall_duration_sec, {pct("is_quality_degraded")} AS bitrate_downgrade_rate,
  {pct("is_outlier")} AS error_rate, count(*) FILTER (WHERE is_buffering) * 100.0::DOUBLE / count(*) AS buf, count(*) FILTER (WHERE is_outlier) * 100.0::DOUBLE / count(*) AS outl,
  quantile_disc(latency_ms, 0.95) AS p95_latency_ms FROM s GROUP BY ALL)
 SELECT * EXCLUDE (stalls, buf, outl) REPLACE (event_date::VARCHAR AS event_date), {hu("stalls", 1)} AS avg_stall_count,
 {hu("greatest(0, least(100, 100 - buf * 0.5::DOUBLE - stalls * 5 - outl * 0.3::DOUBLE - if(p95_latency_ms > 200, 10, 0)))", 1)} AS qoe_score FROM a""",
    "user_engagement_360": f"""WITH v0 AS (FROM {V}), r AS (SELECT max(event_date) AS hi, max(event_date) - 30 AS lo FROM v0),
 v AS (SELECT v0.* FROM v0, r WHERE event_date BETWEEN lo AND hi),
 vw AS (SELECT device_id, {hu(esum("duration_min", 1) + " / 30", 1)} AS avg_daily_viewing_min, {share(LIVE)} AS live, {share(OTT)} AS ott, {share(has("content_source", "HDMI"))} AS ext,
  {share("is_primetime")} AS primetime_ratio, {share("dayofweek(session_start) IN (0, 6)")} AS weekend_ratio, count(DISTINCT channel_name) AS channel_diversity,
  {hu("count(*) / 30", 1)} AS avg_sessions_per_day, {hu(emean("duration_min", 1), 1)} AS avg_session_duration_min FROM v GROUP BY 1),
 ta AS (SELECT device_id, string_agg(app_id, ',' ORDER BY rn) AS top_3_apps FROM (SELECT device_id, app_id, row_number() OVER (PARTITION BY device_id ORDER BY {esum("duration_min", 1)} DESC, app_id) AS rn
  FROM v WHERE app_id IS NOT NULL GROUP BY device_id, app_id) WHERE rn <= 3 GROUP BY 1),
 tg AS (SELECT device_id, string_agg(genre, ',' ORDER BY rn) AS top_3_genres FROM (SELECT device_id, genre, row_number() OVER (PARTITION BY device_id ORDER BY {esum("duration_min", 1)} DESC, genre) AS rn
  FROM v WHERE genre IS NOT NULL GROUP BY device_id, genre) WHERE rn <= 3 GROUP BY 1),
 vc AS (SELECT device_id, {hu("count(*) / 30", 2)} AS voice_usage_rate FROM {T["voice_interactions"]}, r WHERE event_date BETWEEN lo AND hi GROUP BY 1),
 io AS (SELECT device_id, count(DISTINCT iot_device_id) AS iot_device_count FROM {T["iot_interactions"]}, r WHERE event_date BETWEEN lo AND hi GROUP BY 1),
 hd AS (SELECT device_id, count(DISTINCT cec_device_name) AS hdmi_device_count FROM ({bronze.oracle_cte("input_switch_events")}), r WHERE ts::DATE BETWEEN lo AND hi AND trim(cec_device_name) <> '' GROUP BY 1),
 sq AS (SELECT device_id, {hu(emean("100 - if(is_buffering, 20, 0) - stall_count * 5 - if(is_outlier, 10, 0)", 0), 1)} AS avg_streaming_qoe FROM {T["streaming_quality"]}, r WHERE event_date BETWEEN lo AND hi GROUP BY 1),
 cr AS (SELECT device_id, count(*) AS crash_frequency FROM {T["error_events"]}, r WHERE event_date BETWEEN lo AND hi AND is_crash GROUP BY 1),
 ad AS (SELECT device_id, {pct("is_clicked OR is_completed", 1)} AS ad_engagement_rate, {hu(emean("completion_pct", 1), 1)} AS avg_ad_completion_pct FROM {T["ad_funnel"]}, r WHERE event_date BETWEEN lo AND hi GROUP BY 1),
 j AS (SELECT d.device_id, model_name, product_line, region, panel_type, os_version, coalesce(avg_daily_viewing_min, 0) AS avg_daily_viewing_min, coalesce(live, 0) AS live, coalesce(ott, 0) AS ott,
  coalesce(ext, 0) AS ext, top_3_apps, top_3_genres, coalesce(primetime_ratio, 0) AS primetime_ratio, coalesce(weekend_ratio, 0) AS weekend_ratio, coalesce(channel_diversity, 0) AS channel_diversity,
  coalesce(avg_sessions_per_day, 0) AS avg_sessions_per_day, coalesce(avg_session_duration_min, 0) AS avg_session_duration_min, coalesce(voice_usage_rate, 0) AS voice_usage_rate,
  coalesce(iot_device_count, 0) AS iot_device_count, coalesce(hdmi_device_count, 0) AS hdmi_device_count, coalesce(avg_streaming_qoe, 100) AS avg_streaming_qoe,
  coalesce(crash_frequency, 0) AS crash_frequency, coalesce(ad_engagement_rate, 0) AS ad_engagement_rate, coalesce(avg_ad_completion_pct, 0) AS avg_ad_completion_pct
  FROM {D} d LEFT JOIN vw USING (device_id) LEFT JOIN ta USING (device_id) LEFT JOIN tg USING (device_id) LEFT JOIN vc USING (device_id) LEFT JOIN io USING (device_id)
  LEFT JOIN hd USING (device_id) LEFT JOIN sq USING (device_id) LEFT JOIN cr USING (device_id) LEFT JOIN ad USING (device_id))
 SELECT * EXCLUDE (live, ott, ext), CASE WHEN live >= ott AND live >= ext THEN 'live_tv' WHEN ott >= ext THEN 'ott' ELSE 'hdmi' END AS preferred_content_source,
 CASE WHEN avg_daily_viewing_min > 240 AND avg_sessions_per_day > 5 THEN 'power_user' WHEN ott > 70 THEN 'ott_native' WHEN live > 60 THEN 'linear_loyalist'
  WHEN ext > 40 THEN 'gamer' WHEN iot_device_count >= 5 THEN 'smart_home_enthusiast' ELSE 'casual' END AS user_segment FROM j""",
}
