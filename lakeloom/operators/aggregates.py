"""Aggregations that Spark has no single safe function for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import skew


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, name: str = "top") -> DataFrame:
    """Most frequent value per key (smallest on a tie), counted before anything is gathered."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    best = skew.latest_per_key(counts, keys, [F.desc("__n"), F.asc(value)])
    return best.select(*keys, F.col(value).alias(name), F.col("__n").alias(f"{name}_count"))


def top_list(df: DataFrame, keys: Sequence[str], item: str, weight: Column, n: int, name: str) -> DataFrame:
    """The ``n`` heaviest items per key as one list, heaviest first."""
    sums = df.groupBy(*keys, item).agg(F.sum(weight).alias("__w"))
    top = skew.top_per_key(sums, keys, [F.desc("__w"), F.asc(item)], n, "__rn")
    pairs = F.sort_array(F.collect_list(F.struct("__rn", item)))
    return top.groupBy(*keys).agg(F.transform(pairs, lambda p: p[item]).alias(name))


def distinct_list(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted distinct values per key; repeats are dropped before the gather."""
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))


def time_floor(ts: str, seconds: int) -> Column:
    """Start of the fixed-length slot of a timestamp."""
    s = F.unix_seconds(F.col(ts).cast("timestamp"))
    return F.timestamp_seconds(s - F.pmod(s, F.lit(seconds))).cast("timestamp_ntz")


def stats_of(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count and, per column, nulls / distinct / min / max, from one pass."""
    aggs = [F.count("*").alias("rows")]
    for c in cols:
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
            F.count_distinct(c).alias(f"{c}_distinct"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return df.agg(*aggs)


def rank_error(df: DataFrame, keys: Sequence[str], value: str, estimates: DataFrame, estimate: str,
               prob: float) -> DataFrame:
    """How far an estimated quantile's true rank is from the wanted one, per key."""
    joined = df.join(estimates, list(keys))
    below = F.avg(F.when(F.col(value) < F.col(estimate), 1.0).otherwise(0.0))
    upto = F.avg(F.when(F.col(value) <= F.col(estimate), 1.0).otherwise(0.0))
    gap = F.greatest(below - prob, prob - upto, F.lit(0.0))
    return joined.groupBy(*keys).agg(gap.alias("rank_error"))
