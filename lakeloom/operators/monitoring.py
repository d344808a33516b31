"""Profiles, drift between two samples, forecasts and anomalies.

Drift functions read one long frame (``side`` is 'base' or 'current') and reduce it to bins or
distinct values before anything is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.stats import chi2_sf, kolmogorov_sf
from lakeloom.operators.aggregates import most_frequent
from lakeloom.plans import ordered

SHARE_FLOOR = 0.001
PSI_BANDS = [(0.1, "stable"), (0.2, "moderate")]


def profile(df: DataFrame, keys: Sequence[str], column: str, width: float) -> DataFrame:
    """Count, NULL share, distinct count, moments, quartiles and the most frequent value per group."""
    c = F.col(column)
    base = df.groupBy(*keys).agg(
        F.count("*").alias("rows"), (F.count_if(c.isNull()) / F.count("*")).alias("null_share"),
        F.count_distinct(column).alias("distinct"), F.avg(c).alias("mean"), F.stddev(c).alias("stddev"),
        F.min(c).alias("min"), F.max(c).alias("max"))
    quart = ordered.exact_quantiles(df, keys, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}, width)
    top = most_frequent(df, keys, column, "frequent")
    return base.join(quart, list(keys), "left").join(top, list(keys), "left")


def long_features(df: DataFrame, side: Column, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    wide = df.select(*keys, side.alias("side"), *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([*keys, "side"], list(columns), "feature", "value").filter("value IS NOT NULL")


def binned_shares(long: DataFrame, bins: int = 10) -> DataFrame:
    """Share of each side per feature and equal-width bin over the joint range, floored.

    The ranges of all features are one value, an entry per monitored column, that travels to the rows; the rows themselves are counted
    where they are and only counts per feature and bin are exchanged.
    """
    span = long.groupBy("feature").agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("span"))
    spans = span.agg(F.map_from_entries(F.collect_list(F.struct("feature", "span"))))
    lo, hi = F.col("__span.lo"), F.col("__span.hi")
    place = F.when(hi > lo, F.floor((F.col("value") - lo) / (hi - lo) * bins)).otherwise(0)
    binned = long.withColumn("__span", spans.scalar()[F.col("feature")]).withColumn("bin", F.least(F.lit(bins - 1), place).cast("int"))
    counts = binned.groupBy("feature", "bin").agg(
        F.count_if(F.col("side") == "base").alias("b"), F.count_if(F.col("side") == "current").alias("c"))
    whole = Window.partitionBy("feature")  # at most ``bins`` rows each
    return counts.select(
        "feature", "bin", (F.col("b") / F.sum("b").over(whole)).alias("base"), (F.col("c") / F.sum("c").over(whole)).alias("current"))


def psi(long: DataFrame, bins: int = 10) -> DataFrame:
    """Population stability index per feature, empty bins counted with the floor share."""
    floor = F.lit(SHARE_FLOOR)
    shares = binned_shares(long, bins)
    a, e = F.greatest(F.col("current"), floor), F.greatest(F.col("base"), floor)
    # bins empty on both sides cancel out
    out = shares.groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    band = F.when(F.col("psi") < PSI_BANDS[0][0], PSI_BANDS[0][1]).when(F.col("psi") < PSI_BANDS[1][0], PSI_BANDS[1][1]).otherwise("drifted")
    return out.withColumn("band", band)


def jensen_shannon(long: DataFrame, bins: int = 10) -> DataFrame:
    """Jensen-Shannon divergence (base 2) of the binned shares."""
    p, q = F.col("base"), F.col("current")
    m = (p + q) / 2

    def part(x):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    return binned_shares(long, bins).groupBy("feature").agg(F.sum((part(p) + part(q)) / 2).alias("js"))


def kolmogorov_smirnov(long: DataFrame, width: Mapping[str, float] | float) -> DataFrame:
    """Largest distance of the two distribution functions per feature, with its p-value."""
    counts = long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == "base").alias("b"), F.count_if(F.col("side") == "current").alias("c"))
    if isinstance(width, Mapping):
        per = F.create_map(*[F.lit(x) for kv in width.items() for x in kv])[F.col("feature")]
    else:
        per = F.lit(width)
    run = ordered.running(counts, ["feature"], ["value"], F.floor(F.col("value") / per), {"cb": F.col("b"), "cc": F.col("c")}, totals=True)
    gap = F.abs(F.col("cb") / F.col("cb_total") - F.col("cc") / F.col("cc_total"))
    d = run.groupBy("feature").agg(F.max(gap).alias("ks"), F.max("cb_total").alias("n"), F.max("cc_total").alias("m"))
    return d.withColumn("p_value", kolmogorov_sf(F.col("ks"), F.col("n").cast("double"), F.col("m").cast("double"))).drop("n", "m")


def window_drift(df: DataFrame, window: Column, value: str, bins: int = 10) -> DataFrame:
    """Drift of every window against the one before it and against the first one.

    Returns (window, compared_with, psi, ks): ``compared_with`` is 'previous' or 'baseline'. Rows become one count per window and equal-width
    bin of the whole range in a single aggregation; all that follows sees only these. ``ks`` is the largest gap of the binned distributions. The
    first window has nothing to be compared with; rows whose value or window is NULL are left out.
    """
    rows = df.select(window.alias("window"), F.col(value).cast("double").alias("v")).filter("window IS NOT NULL AND v IS NOT NULL")
    span = rows.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    lo, hi = span["lo"], span["hi"]
    place = F.when(hi > lo, F.floor((F.col("v") - lo) / (hi - lo) * bins)).otherwise(0)
    counts = rows.groupBy("window", F.least(F.lit(bins - 1), place).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    per_window = counts.groupBy("window").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"), F.sum("n").alias("total"))
    grid = per_window.select("window", "m", "total", F.explode_outer(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    in_window, in_bin = Window.partitionBy("window").orderBy("bin"), Window.partitionBy("bin").orderBy("window")  # one row per window and bin
    shares = grid.select("window", "bin", (F.coalesce(F.col("m")[F.col("bin")], F.lit(0)) / F.col("total")).alias("share"))
    shares = shares.withColumn("upto", F.sum("share").over(in_window))
    for name, pick in (("previous", F.lag), ("baseline", F.first)):
        shares = shares.withColumn(name, F.struct(
            F.lit(name).alias("compared_with"), pick("share").over(in_bin).alias("share0"), pick("upto").over(in_bin).alias("upto0")))
    later = shares.withColumn("nth", F.row_number().over(in_bin)).filter("nth > 1")
    both = later.select("window", "share", "upto", F.explode(F.array("previous", "baseline")).alias("o"))
    a, e = F.greatest("share", F.lit(SHARE_FLOOR)), F.greatest("o.share0", F.lit(SHARE_FLOOR))
    return both.groupBy("window", "o.compared_with").agg(
        F.sum((a - e) * F.log(a / e)).alias("psi"), F.max(F.abs(F.col("upto") - F.col("o.upto0"))).alias("ks"))


def chi_square(df: DataFrame, side: Column, category: str) -> DataFrame:
    """Homogeneity test of a category between two sides."""
    counts = df.groupBy(F.col(category).alias("cat")).agg(F.count_if(side == "base").alias("b"), F.count_if(side == "current").alias("c"))
    totals = counts.agg(F.sum("b").alias("nb"), F.sum("c").alias("nc"))
    nb, nc = totals.select("nb").scalar(), totals.select("nc").scalar()
    row = (F.col("b") + F.col("c")).cast("double")

    def cell(x, n):
        expected = row * n / (nb + nc)
        return F.pow(x - expected, F.lit(2)) / expected

    out = counts.agg(F.sum(cell(F.col("b"), nb) + cell(F.col("c"), nc)).alias("statistic"), (F.count("*") - 1).alias("df"))
    return out.withColumn("p_value", chi2_sf("statistic", "df"))


def confusion(df: DataFrame, keys: Sequence[str], label: Column, predicted: Column) -> DataFrame:
    """Confusion counts and accuracy, precision, recall, F1 per group."""
    tp, fp = F.count_if(label & predicted), F.count_if(~label & predicted)
    fn, tn = F.count_if(label & ~predicted), F.count_if(~label & ~predicted)
    c = df.groupBy(*keys).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    t = {k: F.col(k) for k in ("tp", "fp", "fn", "tn")}
    return c.withColumns({
        "accuracy": F.try_divide(t["tp"] + t["tn"], t["tp"] + t["tn"] + t["fp"] + t["fn"]),
        "precision": F.try_divide(t["tp"], t["tp"] + t["fp"]), "recall": F.try_divide(t["tp"], t["tp"] + t["fn"]),
        "f1": F.try_divide(2 * t["tp"], 2 * t["tp"] + t["fp"] + t["fn"]),
    })


def forecast(series: DataFrame, keys: Sequence[str], day: str, value: str, horizon: int, season: int = 7) -> DataFrame:
    """Linear trend by least squares and the seasonal-naive value for each day of the horizon.

    ``series`` holds one row per key and day. The season's last values are found by joining on the day.
    """
    x = F.datediff(day, F.lit("1970-01-01").cast("date"))
    fit = series.groupBy(*keys).agg(
        F.regr_slope(value, x).alias("slope"), F.regr_intercept(value, x).alias("intercept"), F.max(day).alias("last"))
    ahead = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    ahead = ahead.withColumn("day", F.expr("date_add(last, step)"))
    back = F.expr(f"date_add(last, step - {season} * cast(ceil(step / {season}) AS int))")
    same = series.select(*keys, F.col(day).alias("__back"), F.col(value).alias("seasonal"))
    trend = F.col("intercept") + F.col("slope") * F.datediff("day", F.lit("1970-01-01").cast("date"))
    return ahead.withColumn("__back", back).join(same, [*keys, "__back"], "left").select(*keys, "day", trend.alias("trend"), "seasonal")


def anomalies(series: DataFrame, keys: Sequence[str], day: str, value: str, window: int = 7, k: float = 2.0) -> DataFrame:
    """Rolling mean +- k standard deviations of the previous rows, and the z-score within the weekday."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(-window, -1)  # one row per key and day
    dow = Window.partitionBy(*keys, F.dayofweek(day))
    mean, sd = F.avg(value).over(w), F.stddev(value).over(w)
    return series.withColumns({
        "rolling_mean": mean, "is_outlier": F.abs(F.col(value) - mean) > k * sd,
        "season_z": F.try_divide(F.col(value) - F.avg(value).over(dow), F.stddev(value).over(dow)),
    })
