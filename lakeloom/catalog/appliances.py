"""Appliance tables (2.18, second part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalog._sql import emean, esum, hu
from lakeloom.operators import appliance as P
from lakeloom.registry import query
from lakeloom.sources import bronze


def raw(t, name):
    return bronze.telemetry(t.events, name)


def sql(name):
    return f"({bronze.oracle_cte(name)})"


GOOD = "pm25 BETWEEN 0 AND 500 AND pm10 BETWEEN 0 AND 1000"
CLEAN = f"""g AS (SELECT DISTINCT * FROM {sql("air_quality")} WHERE {GOOD}), m AS (SELECT region, {hu(emean("humidity", 1), 1)} AS mean FROM g GROUP BY 1),
 c AS (SELECT g.* REPLACE (coalesce(humidity, mean) AS humidity) FROM g JOIN m USING (region))"""


@query("apl_01_air_quality_clean", f"WITH {CLEAN} SELECT event_id, device_id, ts::VARCHAR AS ts, region, pm25, pm10, voc, co2, humidity, air_index FROM c")
def clean(t):
    return P.air_quality(raw(t, "air_quality"))[0].select("event_id", "device_id", "ts", "region", "pm25", "pm10", "voc", "co2", "humidity", "air_index")


@query("apl_01q_air_quality_quarantine", f"""
SELECT event_id, concat_ws(',', if(pm25 BETWEEN 0 AND 500, NULL, 'pm25_range'), if(pm10 BETWEEN 0 AND 1000, NULL, 'pm10_range')) AS violated_rules FROM {sql("air_quality")} WHERE NOT ({GOOD})
""")
def bad(t):
    return P.air_quality(raw(t, "air_quality"))[1].select("event_id", "violated_rules")


@query("apl_02_daily_air_quality", f"""
WITH {CLEAN} SELECT ts::DATE::VARCHAR AS day, region, {hu(emean("pm25", 0), 2)} AS avg_pm25, max(pm25) AS max_pm25, {hu(emean("pm10", 0), 2)} AS avg_pm10, {hu(emean("voc", 1), 2)} AS avg_voc,
 {hu(emean("co2", 0), 2)} AS avg_co2, count(*) AS readings, count(DISTINCT device_id) AS devices, {", ".join(hu(f"count(*) FILTER (WHERE air_index = {i}) * 100.0::DOUBLE / count(*)", 2) + f" AS index_{i}_pct" for i in range(1, 6))}
FROM c GROUP BY ts::DATE, region
""")
def daily(t):
    return P.daily_summary(P.air_quality(raw(t, "air_quality"))[0])


@query("apl_03_filter_lifecycle", f"""
WITH d AS (SELECT DISTINCT * FROM {sql("filter_changes")}) SELECT event_id, device_id, filter_type,
 floor((epoch(date_trunc('second', lead(ts) OVER w))::BIGINT - epoch(date_trunc('second', ts))::BIGINT) / 3600)::BIGINT AS hours_used FROM d WINDOW w AS (PARTITION BY device_id, filter_type ORDER BY ts, event_id)
""")
def filters(t):
    return P.filter_lifecycle(raw(t, "filter_changes"))


@query("apl_04_energy_comparison", f"""
SELECT family, ts::DATE::VARCHAR AS day, {esum("kwh")} AS kwh, sum(hours)::BIGINT AS hours, {hu(esum("kwh") + " / sum(hours)", 4)} AS kwh_per_hour FROM {sql("energy")} GROUP BY 1, ts::DATE
""")
def energy(t):
    return P.energy_comparison(raw(t, "energy"))


@query("apl_05_remote_usage", f"""
SELECT device_id, count(*) AS commands, {hu("count(*) FILTER (WHERE upper(result) = 'SUCCESS') * 100.0::DOUBLE / count(*)", 2)} AS success_pct FROM {sql("remote_commands")} GROUP BY 1
""")
def remote(t):
    return P.remote_usage(raw(t, "remote_commands"))


@query("apl_06_alert_trend", f"""
WITH k AS (SELECT alert_type, date_trunc('week', ts)::DATE AS week, count(*) AS n FROM {sql("alerts")} GROUP BY 1, 2)
SELECT alert_type, week::VARCHAR AS week, n, {hu("(n - lag(n) OVER w) / lag(n) OVER w * 100", 4)} AS growth_pct FROM k WINDOW w AS (PARTITION BY alert_type ORDER BY week)
""")
def trend(t):
    return P.alert_trend(raw(t, "alerts"))


@query("apl_07_seasonal_pattern", f"""
WITH o AS (SELECT *, month(ts::DATE + shift_days::INT) AS m FROM {sql("operation")})
SELECT CASE WHEN m IN (12, 1, 2) THEN 'winter' WHEN m <= 5 THEN 'spring' WHEN m <= 8 THEN 'summer' ELSE 'autumn' END AS season,
 {", ".join(esum(f"CASE WHEN mode = '{m}' THEN hours END", 1) + f" AS {m}" for m in ("auto", "turbo", "sleep"))} FROM o GROUP BY 1
""")
def seasons(t):
    logs = raw(t, "operation").withColumn("day", F.date_add(F.to_date("ts"), F.col("shift_days").cast("int")))
    return P.seasonal_pattern(logs, "day", ["auto", "turbo", "sleep"])


@query("apl_08_device_health", f"""
WITH d AS (SELECT device_id, ts::DATE AS day, sum(CASE severity WHEN 'high' THEN 15 WHEN 'medium' THEN 7 ELSE 2 END)::BIGINT AS penalty, count(*) FILTER (WHERE alert_type = 'error') AS errors FROM {sql("alerts")} GROUP BY 1, 2),
 s AS (SELECT *, greatest(0, least(100, 100 - penalty - errors * 5))::BIGINT AS score FROM d)
SELECT * REPLACE (day::VARCHAR AS day), CASE WHEN score >= 90 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 50 THEN 'C' WHEN score >= 30 THEN 'D' ELSE 'F' END AS grade FROM s
""")
def health(t):
    return P.health_score(raw(t, "alerts"))


@query("apl_09_maintenance_cost", f"""
WITH d AS (SELECT device_id, service, ts::DATE AS day, sum(cost::DECIMAL(18,2)) AS c FROM {sql("maintenance")} GROUP BY 1, 2, 3)
SELECT device_id, service, day::VARCHAR AS day, c::DOUBLE AS cost, (sum(c) OVER (PARTITION BY device_id, service ORDER BY day ROWS UNBOUNDED PRECEDING))::DOUBLE AS running_cost FROM d
""")
def upkeep(t):
    return P.maintenance_cost(raw(t, "maintenance"))
