"""Home appliance logs: air quality, filters, energy, alerts, operation, upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import conditional as C
from lakeloom.functions.literals import exact_mean, exact_sum, half_up
from lakeloom.operators import quality
from lakeloom.operators.metrics import with_growth
from lakeloom.plans import ordered, skew

# Physical ranges, seasons and penalties.
RULES = {"has_device": "device_id IS NOT NULL", "pm25_range": "pm25 BETWEEN 0 AND 500", "pm10_range": "pm10 BETWEEN 0 AND 1000"}
SEASONS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autumn": (9, 10, 11)}
ALERT_PENALTY = {"high": 15, "medium": 7, "low": 2}


def air_quality(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows): one row per device and time, missing humidity from the region's mean."""
    good, bad = quality.quarantine(raw, quality.parse(RULES))
    once = skew.latest_per_key(good, ["device_id", "ts"], [F.asc("event_id")])
    means = once.groupBy("region").agg(half_up(exact_mean("humidity", 1), 1).alias("__mean"))
    filled = once.join(means, "region", "left").withColumn("humidity", F.coalesce("humidity", "__mean")).drop("__mean")
    return filled, bad


def daily_summary(clean: DataFrame) -> DataFrame:
    shares = [half_up(F.count_if(F.col("air_index") == i) * F.lit(100.0) / F.count("*"), 2).alias(f"index_{i}_pct") for i in range(1, 6)]
    return clean.groupBy(F.to_date("ts").alias("day"), "region").agg(
        half_up(exact_mean("pm25", 0), 2).alias("avg_pm25"), F.max("pm25").alias("max_pm25"), half_up(exact_mean("pm10", 0), 2).alias("avg_pm10"),
        half_up(exact_mean("voc", 1), 2).alias("avg_voc"), half_up(exact_mean("co2", 0), 2).alias("avg_co2"), F.count("*").alias("readings"),
        F.count_distinct("device_id").alias("devices"), *shares)


def filter_lifecycle(changes: DataFrame) -> DataFrame:
    """Whole hours between a filter change and the next one of the same kind."""
    once = changes.dropDuplicates(["event_id"])
    seen = ordered.neighbor(once, ["device_id", "filter_type"], ["ts", "event_id"], ordered.day_bucket("ts"), {"next_ts": F.col("ts")}, forward=True)

    def sec(c):
        return F.unix_seconds(F.col(c).cast("timestamp"))

    return seen.select("event_id", "device_id", "filter_type", F.floor((sec("next_ts") - sec("ts")) / 3600).alias("hours_used"))


def energy_comparison(readings: DataFrame) -> DataFrame:
    return readings.groupBy("family", F.to_date("ts").alias("day")).agg(
        exact_sum("kwh").alias("kwh"), F.sum("hours").alias("hours"), half_up(exact_sum("kwh") / F.sum("hours"), 4).alias("kwh_per_hour"))


def remote_usage(commands: DataFrame) -> DataFrame:
    done = F.count_if(F.upper("result") == "SUCCESS")
    return commands.groupBy("device_id").agg(F.count("*").alias("commands"), half_up(done * F.lit(100.0) / F.count("*"), 2).alias("success_pct"))


def alert_trend(alerts: DataFrame) -> DataFrame:
    weekly = alerts.groupBy("alert_type", F.to_date(F.date_trunc("week", "ts")).alias("week")).agg(F.count("*").alias("n"))
    return with_growth(weekly, ["alert_type"], "week", "n").withColumn("growth_pct", half_up(F.col("growth_pct"), 4))


def seasonal_pattern(logs: DataFrame, day: str, modes: list[str]) -> DataFrame:
    month = F.month(day)
    season = F.when(F.lit(False), "")
    for name, months in SEASONS.items():
        season = season.when(month.isin(*months), name)
    return logs.groupBy(season.alias("season")).agg(*[exact_sum(F.when(F.col("mode") == m, F.col("hours")), 1).alias(m) for m in modes])


def health_score(alerts: DataFrame) -> DataFrame:
    """100 minus the alert penalties per device and day, with grade."""
    weight = F.create_map(*[F.lit(x) for kv in ALERT_PENALTY.items() for x in kv])[F.col("severity")]
    day = alerts.groupBy("device_id", F.to_date("ts").alias("day")).agg(
        F.sum(weight).alias("penalty"), F.count_if(F.col("alert_type") == "error").alias("errors"))
    scored = day.withColumn("score", C.penalty_score([F.col("penalty"), F.col("errors") * 5]).cast("bigint"))
    return scored.withColumn("grade", C.band_from(F.col("score"), [(90, "A"), (70, "B"), (50, "C"), (30, "D")], "F"))


def maintenance_cost(jobs: DataFrame) -> DataFrame:
    """Cost per device, service and day with its running total; days are few per device."""
    daily = jobs.groupBy("device_id", "service", F.to_date("ts").alias("day")).agg(exact_sum("cost").alias("cost"))
    w = Window.partitionBy("device_id", "service").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("running_cost", F.sum(F.col("cost").cast("decimal(18,2)")).over(w).cast("double"))
