"""Pivot and unpivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot(
    df: DataFrame, keys: Sequence[str], on: str, values: Mapping, aggs: Mapping[str, Column]
) -> DataFrame:
    """Listed values become columns ``<label>`` (one aggregate) or ``<label>_<agg>``.

    The rows are aggregated per (keys, value) first, so the pivot itself reads the small result.
    """
    named = [c.alias(n) for n, c in aggs.items()]
    small = df.filter(F.col(on).isin(*values)).groupBy(*keys, on).agg(*named)
    single = len(aggs) == 1
    cols = [
        F.max(F.when(F.col(on) == v, F.col(n))).alias(label if single else f"{label}_{n}")
        for v, label in values.items() for n in aggs
    ]
    base = df.select(*keys).distinct() if keys else None
    wide = small.groupBy(*keys).agg(*cols)
    return base.join(wide, list(keys), "left") if base is not None else wide


def pivot_dynamic(df: DataFrame, keys: Sequence[str], on: str, agg: Column) -> DataFrame:
    """Pivot on the values found in the data; ``spark.sql.pivotMaxValues`` bounds the number of columns."""
    return df.groupBy(*keys).pivot(on).agg(agg)


def unpivot(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str, value: str, keep_nulls: bool = False
) -> DataFrame:
    long = df.unpivot(list(keys), list(cols), name, value)
    return long if keep_nulls else long.filter(F.col(value).isNotNull())


def attributes(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Entity-attribute-value rows with every value as text."""
    texts = df.select(key, *[F.col(c).cast("string").alias(c) for c in cols])
    return unpivot(texts, [key], cols, "attribute", "value")
