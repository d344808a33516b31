"""Device telemetry, cleaned tables to summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import conditional as C
from lakeloom.functions.literals import exact_mean, exact_sum, half_up
from lakeloom.operators.joins import full_join_on
from lakeloom.operators.quality import fail_on_bad
from lakeloom.plans import skew

# Keywords, penalties, grades and segment limits of the summaries.
LIVE, OTT, HDMI = ["LIVE", "TV"], ["OTT", "STREAM", "APP"], ["HDMI", "EXTERNAL"]
UHD = ["2160", "3840", "4K"]
GRADES = [(90, "A"), (70, "B"), (50, "C"), (30, "D")]
DIRTY = ["DIRTY", "ABNORMAL", "CRASH", "WATCHDOG"]
REBOOTS = ["POWER_ON", "COLD_BOOT", "WARM_BOOT", "REBOOT"]
PROGRAM_SECONDS = 1800
PROFILE_DAYS = 30


def _minutes_if(test: Column) -> Column:
    return exact_sum(F.when(test, F.col("duration_min")).otherwise(0.0), 1)


def _share_if(test: Column) -> Column:
    return half_up(_minutes_if(test) * 100.0 / F.greatest(exact_sum("duration_min", 1), F.lit(1.0)), 1)


def _one_decimal(c: Column) -> Column:
    return half_up(c, 1)


def daily_viewing_summary(viewing: DataFrame, devices: DataFrame) -> DataFrame:
    keys = ["device_id", "event_date"]
    source = F.col("content_source")

    def favourite(col: str, name: str) -> DataFrame:
        sums = viewing.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(exact_sum("duration_min", 1).alias("w"))
        return skew.latest_per_key(sums, keys, [F.desc("w"), F.asc(col)]).select(*keys, F.col(col).alias(name))

    total = viewing.groupBy(*keys).agg(
        _one_decimal(exact_sum("duration_min", 1)).alias("total_viewing_min"), F.count("*").alias("session_count"),
        _one_decimal(exact_mean("duration_min", 1)).alias("avg_session_min"), F.max("duration_min").alias("max_session_min"),
        _one_decimal(_minutes_if(C.contains_any(source, LIVE) | C.contains_any(F.col("broadcast_type"), ["LIVE"]))).alias("live_tv_min"),
        _one_decimal(_minutes_if(C.contains_any(source, OTT))).alias("ott_min"),
        _one_decimal(_minutes_if(C.contains_any(source, HDMI))).alias("hdmi_min"),
        F.count_distinct("channel_name").alias("unique_channels"), _one_decimal(_minutes_if(F.col("is_primetime"))).alias("primetime_min"),
        _share_if(F.col("hdr_type") != "SDR").alias("hdr_viewing_pct"),
        _share_if(C.contains_any(F.col("resolution"), UHD)).alias("uhd_viewing_pct"))
    about = devices.select("device_id", "region", "product_line", "panel_type")
    out = (total.join(favourite("app_id", "top_app"), keys, "left").join(favourite("genre", "top_genre"), keys, "left")
           .join(about, "device_id"))
    return fail_on_bad(out, {"valid_viewing": F.col("total_viewing_min") >= 0})


def content_popularity(viewing: DataFrame, devices: DataFrame) -> DataFrame:
    active = viewing.agg(F.count_distinct("device_id"))
    mine = viewing.join(devices.select("device_id"), "device_id", "left_semi")
    done = F.least(F.col("duration_sec") * 100.0 / PROGRAM_SECONDS, F.lit(100.0))
    base = mine.groupBy("program_title", "genre", "content_source", "event_date").agg(
        F.count_distinct("device_id").alias("total_viewers"), _one_decimal(exact_sum("duration_min", 1)).alias("total_viewing_min"),
        _one_decimal(exact_mean("duration_min", 1)).alias("avg_viewing_min"), _one_decimal(exact_mean(done, 6)).alias("completion_rate"))
    reach = half_up(F.col("total_viewers") * F.lit(100.0) / F.greatest(active.scalar(), F.lit(1)), 2)
    return fail_on_bad(base.withColumn("reach_pct", reach), {"valid_viewers": F.col("total_viewers") > 0})


def ad_campaign_kpi(ads: DataFrame) -> DataFrame:
    n, devices = F.count("*"), F.count_distinct("device_id")
    money = F.coalesce(exact_sum("bid_price_usd"), F.lit(0.0))

    def pct(flag):
        return half_up(F.count_if(F.col(flag)) * F.lit(100.0) / F.greatest(n, F.lit(1)), 2)

    out = ads.groupBy("campaign_id", "advertiser_name", "ad_format", "placement", "event_date").agg(
        n.alias("impressions"), F.count_if(F.col("is_clicked")).alias("clicks"), F.count_if(F.col("is_completed")).alias("completions"),
        F.count_if(F.col("is_skipped")).alias("skips"), F.count_if(F.upper("ad_event").contains("ERROR")).alias("errors"),
        pct("is_clicked").alias("ctr"), pct("is_completed").alias("vcr"),
        _one_decimal(exact_mean("completion_pct", 1)).alias("avg_completion_pct"), half_up(money, 2).alias("total_revenue_usd"),
        half_up(money / F.greatest(n, F.lit(1)) * 1000, 2).alias("ecpm"), devices.alias("unique_devices"),
        _one_decimal(n / F.greatest(devices, F.lit(1))).alias("frequency"))
    return fail_on_bad(out, {"valid_impressions": F.col("impressions") > 0})


def device_health_score(metrics: DataFrame, errors: DataFrame, boots: DataFrame, devices: DataFrame) -> DataFrame:
    keys = ["device_id", "event_date"]
    m = metrics.groupBy(*keys).agg(
        _one_decimal(exact_mean("avg_cpu_pct", 1)).alias("avg_cpu_pct"), _one_decimal(exact_mean("avg_mem_used_pct", 1)).alias("avg_mem_pct"),
        F.max("peak_thermal_0_c").alias("peak_soc_temp"), F.max("peak_thermal_1_c").alias("peak_panel_temp"),
        F.count_if(F.col("any_thermal_throttle")).alias("throttle_count"))
    e = errors.groupBy(*keys).agg(*[F.count_if(F.col(f"is_{k}")).alias(f"{k}_count") for k in ("crash", "oom", "media_error")])
    b = boots.groupBy(*keys).agg(
        F.count_if(F.col("boot_event").isin(*REBOOTS)).alias("reboot_count"),
        F.count_if(F.upper("previous_shutdown").isin(*DIRTY)).alias("dirty_shutdown_count"))
    counts = ["throttle_count", "crash_count", "oom_count", "media_error_count", "reboot_count", "dirty_shutdown_count"]
    day = full_join_on([m, e, b], keys).fillna(0, [*counts, "avg_cpu_pct", "avg_mem_pct"])
    hot = F.coalesce(F.col("peak_soc_temp") > 75, F.lit(False))
    busy = F.col("avg_cpu_pct") > 80
    weights = {"crash_count": 10, "oom_count": 8, "throttle_count": 5, "dirty_shutdown_count": 15, "media_error_count": 3}
    penalties = [F.col(c) * w for c, w in weights.items()] + [F.when(x, 5).otherwise(0) for x in (busy, hot)]
    risks = {
        "high_crash_rate": F.col("crash_count") >= 3, "oom_frequent": F.col("oom_count") >= 2,
        "thermal_throttle": F.col("throttle_count") >= 3, "dirty_shutdown": F.col("dirty_shutdown_count") >= 1,
        "high_cpu": busy, "high_temperature": hot, "media_errors": F.col("media_error_count") >= 3,
    }
    scored = day.withColumn("health_score", C.penalty_score(penalties).cast("bigint"))
    out = scored.withColumns({"health_grade": C.band_from(F.col("health_score"), GRADES, "F"), "risk_factors": C.flags(risks)})
    out = fail_on_bad(out, {"valid_health_score": F.col("health_score").between(0, 100)})
    return out.join(devices.select("device_id", "product_line", "os_version"), "device_id", "left")


def streaming_qoe(streams: DataFrame, devices: DataFrame) -> DataFrame:
    keys = ["app_id", "region", "quality_tier", "event_date"]
    mine = streams.join(devices.select("device_id", "region"), "device_id")
    n = F.greatest(F.count("*"), F.lit(1))

    def rate(flag):
        return F.count_if(F.col(flag)) * F.lit(100.0) / n

    base = mine.groupBy(*keys).agg(
        F.count("*").alias("total_streams"), F.count_distinct("device_id").alias("unique_devices"),
        half_up(exact_mean("current_bitrate_kbps", 0), 0).alias("avg_bitrate_kbps"),
        _one_decimal(exact_mean("latency_ms", 0)).alias("avg_latency_ms"), half_up(rate("is_buffering"), 2).alias("buffering_rate"),
        exact_mean("stall_count", 0).alias("__stalls"), half_up(exact_mean(F.col("stall_duration_total_ms") / 1000.0, 3), 2).alias("avg_stall_duration_sec"),
        half_up(rate("is_quality_degraded"), 2).alias("bitrate_downgrade_rate"), half_up(rate("is_outlier"), 2).alias("error_rate"),
        rate("is_buffering").alias("__buffering"), rate("is_outlier").alias("__outliers"),
        F.percentile_approx("latency_ms", 0.95, 10000).alias("p95_latency_ms"))
    slow = F.when(F.col("p95_latency_ms") > 200, 10).otherwise(0)
    score = C.penalty_score([F.col("__buffering") * 0.5, F.col("__stalls") * 5, F.col("__outliers") * 0.3, slow])
    out = base.withColumns({"avg_stall_count": _one_decimal(F.col("__stalls")), "qoe_score": _one_decimal(score)})
    return fail_on_bad(out.drop("__stalls", "__buffering", "__outliers"), {"valid_qoe": F.col("qoe_score").between(0, 100)})


def _viewing_profile(seen: DataFrame) -> DataFrame:
    """Per device: time and shares, distinct channels and the three heaviest apps and genres, from one pass over the sessions.

    Sessions are summed per device, per app, per genre and per channel at once; the second aggregate sees one row per distinct value.
    """
    source = F.col("content_source")
    weight = F.sum(F.col("duration_min").cast("decimal(18,1)"))
    sets = [["device_id"], *[["device_id", c] for c in ("app_id", "genre", "channel_name")]]
    sums = seen.groupingSets(sets, "device_id", "app_id", "genre", "channel_name").agg(
        F.grouping_id().alias("level"), weight.alias("w"), F.struct(
            _one_decimal(exact_sum("duration_min", 1) / PROFILE_DAYS).alias("avg_daily_viewing_min"),
            _share_if(C.contains_any(source, LIVE)).alias("live_tv_pct"), _share_if(C.contains_any(source, OTT)).alias("ott_pct"),
            _share_if(C.contains_any(source, ["HDMI"])).alias("hdmi_pct"), _share_if(F.col("is_primetime")).alias("primetime_ratio"),
            _share_if(F.dayofweek("session_start").isin(1, 7)).alias("weekend_ratio"),
            _one_decimal(F.count("*") / PROFILE_DAYS).alias("avg_sessions_per_day"),
            _one_decimal(exact_mean("duration_min", 1)).alias("avg_session_duration_min")).alias("whole"))
    # a bit of the level is set for each column that a row does not name
    whole, app, genre, channel = (F.col("level") == n for n in (0b0111, 0b0011, 0b0101, 0b0110))

    def top(level: Column, name: str) -> Column:
        held = F.collect_list(F.when(level & F.col(name).isNotNull(), F.struct((-F.col("w")).alias("w"), F.col(name).alias("item"))))
        return F.transform(F.slice(F.sort_array(held), 1, 3), lambda x: x["item"])

    per_device = sums.groupBy("device_id").agg(
        F.first(F.when(whole, F.col("whole")), ignorenulls=True).alias("whole"),
        F.count_if(channel & F.col("channel_name").isNotNull()).alias("channel_diversity"),
        top(app, "app_id").alias("__apps"), top(genre, "genre").alias("__genres"))
    listed = [F.when(F.size(c) > 0, F.col(c)).alias(n) for c, n in (("__apps", "top_3_apps"), ("__genres", "top_3_genres"))]
    return per_device.select("device_id", "whole.*", "channel_diversity", *listed)


def user_engagement_360(devices, viewing, voice, iot, switches, streams, errors, ads) -> DataFrame:
    """Profile per device over the last 30 days of viewing. ``viewing`` is read twice (for its last day first), every other table once."""
    last = F.lit(viewing.agg(F.max("event_date")).first()[0]).cast("date")

    def recent(df: DataFrame) -> DataFrame:
        return df.filter(F.col("event_date").between(F.date_sub(last, PROFILE_DAYS), last))

    key = ["device_id"]
    view = _viewing_profile(recent(viewing))
    qoe = 100 - F.when(F.col("is_buffering"), 20).otherwise(0) - F.col("stall_count") * 5 - F.when(F.col("is_outlier"), 10).otherwise(0)
    hdmi = switches.filter(F.col("cec_device_name").isNotNull() & (F.trim("cec_device_name") != ""))
    parts = [
        view,
        recent(voice).groupBy(*key).agg(half_up(F.count("*") / PROFILE_DAYS, 2).alias("voice_usage_rate")),
        recent(iot).groupBy(*key).agg(F.count_distinct("iot_device_id").alias("iot_device_count")),
        recent(hdmi).groupBy(*key).agg(F.count_distinct("cec_device_name").alias("hdmi_device_count")),
        recent(streams).groupBy(*key).agg(_one_decimal(exact_mean(qoe, 0)).alias("avg_streaming_qoe")),
        recent(errors).filter("is_crash").groupBy(*key).agg(F.count("*").alias("crash_frequency")),
        recent(ads).groupBy(*key).agg(
            half_up(F.count_if(F.col("is_clicked") | F.col("is_completed")) * F.lit(100.0) / F.count("*"), 1).alias("ad_engagement_rate"),
            _one_decimal(exact_mean("completion_pct", 1)).alias("avg_ad_completion_pct")),
    ]
    about = devices.select("device_id", "model_name", "product_line", "region", "panel_type", "os_version")
    joined = reduce(lambda a, b: a.join(b, "device_id", "left"), parts, about)
    zero = [c for p in parts for c in p.columns if c not in ("device_id", "avg_streaming_qoe", "top_3_apps", "top_3_genres")]
    full = joined.fillna(0, zero).fillna(100, ["avg_streaming_qoe"])
    live, ott, ext = F.col("live_tv_pct"), F.col("ott_pct"), F.col("hdmi_pct")
    out = full.withColumns({
        "preferred_content_source": F.when((live >= ott) & (live >= ext), "live_tv").when(ott >= ext, "ott").otherwise("hdmi"),
        "user_segment": F.when((F.col("avg_daily_viewing_min") > 240) & (F.col("avg_sessions_per_day") > 5), "power_user")
        .when(ott > 70, "ott_native").when(live > 60, "linear_loyalist").when(ext > 40, "gamer")
        .when(F.col("iot_device_count") >= 5, "smart_home_enthusiast").otherwise("casual"),
    })
    return fail_on_bad(out.drop("live_tv_pct", "ott_pct", "hdmi_pct"), {"valid_viewing": F.col("avg_daily_viewing_min") >= 0})
