"""Reusable metric definitions: named dimensions and measures, aggregated again at every grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MetricView:
    """Measures are aggregate expressions, so a ratio is always a ratio of sums at the asked grain."""

    source: DataFrame
    dimensions: Mapping[str, Column]
    measures: Mapping[str, Column]
    where: Column | None = None
    rounding: Mapping[str, int] = field(default_factory=dict)

    def query(self, dims: Sequence[str], measures: Sequence[str], where: Column | None = None) -> DataFrame:
        df = self.source.filter(self.where) if self.where is not None else self.source
        df = df.filter(where) if where is not None else df
        keys = [self.dimensions[d].alias(d) for d in dims]
        return df.groupBy(*keys).agg(*[self.measures[m].alias(m) for m in measures])


def with_growth(df: DataFrame, series: Sequence[str], period: str, measure: str, name: str = "growth_pct") -> DataFrame:
    """Change in percent to the previous period of the same series (NULL for the first)."""
    prev = F.lag(measure).over(Window.partitionBy(*series).orderBy(period))
    return df.withColumn(name, F.try_divide(F.col(measure) - prev, prev) * 100)


def evaluate_alerts(metrics: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alerts (name, metric, operator, threshold) joined with metric values (metric, value); fired ones only."""
    joined = metrics.join(alerts, "metric")
    value, threshold, op = F.col("value"), F.col("threshold"), F.col("operator")
    fired = (F.when(op == ">", value > threshold).when(op == ">=", value >= threshold).when(op == "<", value < threshold)
             .when(op == "<=", value <= threshold).when(op == "=", value == threshold).otherwise(value != threshold))
    return joined.filter(fired)


def funnel(df: DataFrame, user: str, stages: Mapping[str, Column]) -> DataFrame:
    """Distinct users per stage and their share of the previous stage."""
    per_user = df.groupBy(user).agg(*[F.bool_or(c).alias(n) for n, c in stages.items()])
    wide = per_user.agg(*[F.count_if(F.col(n)).alias(n) for n in stages])
    order = F.create_map(*[F.lit(x) for i, n in enumerate(stages) for x in (n, i + 1)])
    long = wide.unpivot([], list(stages), "stage", "users").withColumn("step", order[F.col("stage")])
    prev = F.lag("users").over(Window.orderBy("step"))  # one row per stage
    return long.withColumn("rate", F.try_divide(F.col("users") * 100, prev))


def cohort_retention(events: DataFrame, user: str, day: Column) -> DataFrame:
    """Users seen again per first-seen day and day offset, with the cohort size and the share."""
    days = events.select(user, day.alias("day")).distinct()
    first = days.groupBy(user).agg(F.min("day").alias("cohort"))
    counts = days.join(first, user).groupBy("cohort", F.datediff("day", "cohort").alias("day_offset")).agg(F.count("*").alias("retained"))
    sizes = first.groupBy("cohort").agg(F.count("*").alias("cohort_users"))
    return counts.join(sizes, "cohort").withColumn("retention_pct", F.col("retained") * F.lit(100.0) / F.col("cohort_users"))
