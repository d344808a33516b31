"""Monitoring, drift, time series (2.15). Early against late ship dates give the two samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalog._sql import emean, hu
from lakeloom.functions.literals import exact_mean, half_up, ntz
from lakeloom.operators import monitoring as N
from lakeloom.registry import query

FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]
SIDE_SQL = "CASE WHEN l_shipdate < TIMESTAMP '1998-06-01' THEN 'base' ELSE 'current' END"


def side():
    return F.when(F.col("l_shipdate") < ntz("1998-06-01"), "base").otherwise("current")


def long(t):
    return N.long_features(t.lineitem, side(), FEATURES)


BINS_SQL = f"""
l AS (SELECT {SIDE_SQL} AS side, feature, value FROM lineitem, LATERAL (VALUES ('l_quantity', l_quantity), ('l_extendedprice', l_extendedprice), ('l_discount', l_discount)) f(feature, value)),
r AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM l GROUP BY 1),
b AS (SELECT feature, least(9, floor((value - lo) / (hi - lo) * 10))::INT AS bin, count(*) FILTER (WHERE side = 'base') AS b, count(*) FILTER (WHERE side = 'current') AS c FROM l JOIN r USING (feature) GROUP BY 1, 2),
s AS (SELECT feature, bin, b / sum(b) OVER (PARTITION BY feature) AS p, c / sum(c) OVER (PARTITION BY feature) AS q FROM b)
"""
PSI_SQL = "SELECT feature, sum((greatest(q, 0.001::DOUBLE) - greatest(p, 0.001::DOUBLE)) * ln(greatest(q, 0.001::DOUBLE) / greatest(p, 0.001::DOUBLE))) AS psi FROM s GROUP BY 1"


@query("mon_01_profile", """
WITH f AS (SELECT event_type, ts::DATE AS day, value, count(*) AS n FROM events GROUP BY 1, 2, 3),
 m AS (SELECT event_type, day, value AS frequent, n AS frequent_count FROM f QUALIFY row_number() OVER (PARTITION BY event_type, day ORDER BY n DESC, value) = 1)
SELECT event_type, ts::DATE::VARCHAR AS day, count(*) AS rows, count(DISTINCT value) AS "distinct", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
 min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3,
 any_value(frequent) AS frequent, any_value(frequent_count) AS frequent_count, 0.0::DOUBLE AS null_share
FROM events JOIN m USING (event_type) WHERE ts::DATE = m.day GROUP BY event_type, ts::DATE
""")
def profile(t):
    p = N.profile(t.events.withColumn("day", F.to_date("ts")), ["event_type", "day"], "value", 1.0)
    return p.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "q1", "median", "q3")})


@query("mon_02_psi", f"WITH {BINS_SQL}, x AS ({PSI_SQL}) SELECT feature, round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'drifted' END AS band FROM x")
def psi(t):
    return N.psi(long(t)).withColumn("psi", F.round("psi", 6))


KS_SQL = """
c AS (SELECT feature, value, count(*) FILTER (WHERE side = 'base') AS b, count(*) FILTER (WHERE side = 'current') AS c FROM l GROUP BY 1, 2),
d AS (SELECT feature, sum(b) OVER w / sum(b) OVER (PARTITION BY feature) - sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS gap FROM c
 WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING))
"""


@query("mon_03_kolmogorov_smirnov", f"""
WITH {BINS_SQL}, {KS_SQL}, k AS (SELECT feature, max(abs(gap)) AS ks FROM d GROUP BY 1),
 n AS (SELECT feature, count(*) FILTER (WHERE side = 'base')::DOUBLE AS n, count(*) FILTER (WHERE side = 'current')::DOUBLE AS m FROM l GROUP BY 1),
 z AS (SELECT feature, ks, ks * ks * n * m / (n + m) AS z FROM k JOIN n USING (feature))
SELECT feature, round(ks, 6) AS ks, round(CASE WHEN z < 0.04 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
 list_sum(list_transform(range(1, 101), lambda i: (CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END)::DOUBLE * exp(-2.0::DOUBLE * z * i * i))))) END, 6) AS p_value FROM z
""")
def ks(t):
    out = N.kolmogorov_smirnov(long(t), {"l_quantity": 1.0, "l_extendedprice": 500.0, "l_discount": 0.01})
    return out.select("feature", F.round("ks", 6).alias("ks"), F.round("p_value", 6).alias("p_value"))


@query("mon_04_chi_square", f"""
WITH c AS (SELECT l_returnflag AS cat, count(*) FILTER (WHERE {SIDE_SQL} = 'base') AS b, count(*) FILTER (WHERE {SIDE_SQL} = 'current') AS c FROM lineitem GROUP BY 1),
 n AS (SELECT sum(b)::DOUBLE AS nb, sum(c)::DOUBLE AS nc FROM c)
SELECT round(x, 6) AS statistic, df, round(exp(-x / 2), 6) AS p_value FROM (SELECT count(*) - 1 AS df,
 sum(power(b - (b + c) * nb / (nb + nc), 2) / ((b + c) * nb / (nb + nc)) + power(c - (b + c) * nc / (nb + nc), 2) / ((b + c) * nc / (nb + nc))) AS x FROM c, n)
""")
def chi(t):
    """Three flags, so two degrees of freedom, for which the tail is exp(-x / 2)."""
    return N.chi_square(t.lineitem, side(), "l_returnflag").select(
        F.round("statistic", 6).alias("statistic"), "df", F.round("p_value", 6).alias("p_value"))


@query("mon_05_jensen_shannon", f"""
WITH {BINS_SQL} SELECT feature, round(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 6) AS js
FROM s GROUP BY 1
""")
def js(t):
    return N.jensen_shannon(long(t)).withColumn("js", F.round("js", 6))


@query("mon_06_drift_table", f"""
WITH {BINS_SQL}, {KS_SQL}, x AS ({PSI_SQL}), k AS (SELECT feature, max(abs(gap)) AS ks FROM d GROUP BY 1)
SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, psi > 0.2 OR ks > 0.1 AS drifted FROM x JOIN k USING (feature)
""")
def drift_table(t):
    ks_ = N.kolmogorov_smirnov(long(t), {"l_quantity": 1.0, "l_extendedprice": 500.0, "l_discount": 0.01})
    both = N.psi(long(t)).join(ks_, "feature")
    return both.select("feature", F.round("psi", 6).alias("psi"), F.round("ks", 6).alias("ks"), ((F.col("psi") > 0.2) | (F.col("ks") > 0.1)).alias("drifted"))


@query("mon_06b_drift_by_window", """
WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
 c AS (SELECT date_trunc('week', ts) AS w, least(9, floor((value - lo) / (hi - lo) * 10))::INT AS bin, count(*) AS n FROM events, r GROUP BY 1, 2),
 g AS (SELECT w, bin, coalesce(n, 0) / sum(n) OVER (PARTITION BY w) AS p FROM (SELECT DISTINCT w FROM c) JOIN (SELECT unnest(range(10))::INT AS bin) ON true LEFT JOIN c USING (w, bin)),
 u AS (SELECT w, bin, p, sum(p) OVER (PARTITION BY w ORDER BY bin) AS f FROM g),
 n AS (SELECT w, lag(w) OVER (ORDER BY w) AS previous, first(w) OVER (ORDER BY w) AS baseline FROM (SELECT DISTINCT w FROM c)),
 o AS (SELECT w, 'previous' AS compared_with, previous AS w0 FROM n WHERE previous IS NOT NULL UNION ALL SELECT w, 'baseline', baseline FROM n WHERE w > baseline)
SELECT o.w::DATE::VARCHAR AS week, compared_with, round(sum((greatest(a.p, 0.001::DOUBLE) - greatest(b.p, 0.001::DOUBLE)) * ln(greatest(a.p, 0.001::DOUBLE) / greatest(b.p, 0.001::DOUBLE))), 6) AS psi,
 round(max(abs(a.f - b.f)), 6) AS ks FROM o JOIN u a ON a.w = o.w JOIN u b ON b.w = o.w0 AND b.bin = a.bin GROUP BY 1, 2
""")
def drift_by_window(t):
    drift = N.window_drift(t.events, F.date_trunc("week", "ts"), "value")
    return drift.select(F.to_date("window").alias("week"), "compared_with", F.round("psi", 6).alias("psi"), F.round("ks", 6).alias("ks"))


@query("mon_07_custom_metric", """
SELECT ts::DATE::VARCHAR AS day, round(sum(value * 2), 2) AS weighted, count(DISTINCT user_id) AS users FROM events GROUP BY ts::DATE
""")
def custom(t):
    definitions = {"weighted": "round(sum(value * 2), 2)", "users": "count(DISTINCT user_id)"}
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(*[F.expr(e).alias(n) for n, e in definitions.items()])


@query("mon_08_mean_deviation", f"""
WITH b AS (SELECT event_type, {emean("value")} AS base FROM events WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 1),
 d AS (SELECT event_type, ts::DATE AS day, {emean("value")} AS mean FROM events WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY 1, 2)
SELECT event_type, day::VARCHAR AS day, {hu("abs(mean - base) / base * 100", 4)} AS deviation_pct FROM d JOIN b USING (event_type) WHERE abs(mean - base) / base > 0.2
""")
def deviation(t):
    early = F.col("ts") < ntz("2024-01-11")
    base = t.events.filter(early).groupBy("event_type").agg(exact_mean("value").alias("base"))
    daily = t.events.filter(~early).groupBy("event_type", F.to_date("ts").alias("day")).agg(exact_mean("value").alias("mean"))
    off = F.abs(F.col("mean") - F.col("base")) / F.col("base")
    return daily.join(base, "event_type").filter(off > 0.2).select("event_type", "day", half_up(off * 100, 4).alias("deviation_pct"))


@query("mon_09_hourly_predictions", f"""
SELECT date_trunc('hour', ts)::VARCHAR AS hour, 'v' || event_id % 3 AS model, count(*) AS n, {hu(emean("value"), 4)} AS mean, max(value) AS top FROM events GROUP BY date_trunc('hour', ts), 2
""")
def hourly(t):
    model = F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string"))
    return t.events.groupBy(F.date_trunc("hour", "ts").alias("hour"), model.alias("model")).agg(
        F.count("*").alias("n"), half_up(exact_mean("value"), 4).alias("mean"), F.max("value").alias("top"))


@query("mon_10_retraining_decision", f"""
WITH {BINS_SQL}, x AS ({PSI_SQL}) SELECT count(*) FILTER (WHERE psi > 0.0002) > 0 AS retrain, string_agg(feature, ',' ORDER BY feature) FILTER (WHERE psi > 0.0002) AS features FROM x
""")
def retrain(t):
    over = N.psi(long(t)).filter("psi > 0.0002")
    return over.agg((F.count("*") > 0).alias("retrain"), F.array_sort(F.collect_list("feature")).alias("features"))


SERIES_SQL = "s AS (SELECT event_type, ts::DATE AS day, count(*)::DOUBLE AS n FROM events GROUP BY 1, 2)"


def series(t):
    return t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").cast("double").alias("n"))


@query("mon_11_forecast", f"""
WITH {SERIES_SQL}, f AS (SELECT event_type, regr_slope(n, day - DATE '1970-01-01') AS b, regr_intercept(n, day - DATE '1970-01-01') AS a, max(day) AS last FROM s GROUP BY 1),
 h AS (SELECT f.*, step, (last + step)::DATE AS day, (last + step - 7 * ceil(step / 7)::INT)::DATE AS back FROM f, (SELECT range::INT AS step FROM range(1, 11)))
SELECT h.event_type, h.day::VARCHAR AS day, round(a + b * (h.day - DATE '1970-01-01'), 4) AS trend, n AS seasonal FROM h LEFT JOIN s ON s.event_type = h.event_type AND s.day = back
""")
def forecast(t):
    return N.forecast(series(t), ["event_type"], "day", "n", 10).withColumn("trend", F.round("trend", 4))


@query("mon_12_series_anomaly", f"""
WITH {SERIES_SQL} SELECT event_type, day::VARCHAR AS day, n, round(avg(n) OVER w, 4) AS rolling_mean, abs(n - avg(n) OVER w) > 2 * stddev_samp(n) OVER w AS is_outlier,
 round((n - avg(n) OVER z) / stddev_samp(n) OVER z, 4) AS season_z FROM s
WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), z AS (PARTITION BY event_type, dayofweek(day))
""")
def anomaly(t):
    out = N.anomalies(series(t), ["event_type"], "day", "n")
    return out.withColumns({c: F.round(c, 4) for c in ("rolling_mean", "season_z")})


LABEL, PRED = "event_type = 'purchase' OR value > 120", "value > 80 OR event_id % 7 = 0"
CONF_SQL = f"c AS (SELECT ts::DATE AS day, count(*) FILTER (WHERE ({LABEL}) AND ({PRED})) AS tp, count(*) FILTER (WHERE NOT ({LABEL}) AND ({PRED})) AS fp, count(*) FILTER (WHERE ({LABEL}) AND NOT ({PRED})) AS fn, count(*) FILTER (WHERE NOT ({LABEL}) AND NOT ({PRED})) AS tn FROM events GROUP BY 1)"


@query("mon_13_classification_quality", f"""
WITH {CONF_SQL} SELECT day::VARCHAR AS day, tp, fp, fn, tn, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
 round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c
""")
def classification(t):
    out = N.confusion(t.events.withColumn("day", F.to_date("ts")), ["day"], F.expr(LABEL), F.expr(PRED))
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})
