"""What the two vector searches share: usable rows, dealing queries against rows in blocks, and merging their best."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.plans import durable

ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 8192, 1024


def usable(rows: DataFrame, id_col: str, vector_col: str, zero_too: bool) -> DataFrame:
    """(id, v), written once: vectors of the table's most common length without null, NaN or infinite components.

    ``zero_too`` says whether vectors of zeros count. A null id cannot be returned and is left out; of rows that share an id the
    smallest vector counts, so repeated rows count once.
    """
    v = F.col("v")
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if not zero_too:
        fine = fine & F.exists(v, lambda x: x != 0)
    rows = durable.cut(rows.filter(F.col("id").isNotNull() & v.isNotNull()).filter(fine).groupBy("id").agg(F.min("v").alias("v")),
                       "vectors")
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).agg(F.max("n")).first()[0]
    return rows.filter(F.size("v") == (length or 0))


def blocks(n: int, most: int) -> int:
    return max(1, math.ceil(n / most))


def share(id_col: str, parts: Column | int) -> Column:
    """The part that a hash of the id deals a row to."""
    return F.pmod(F.xxhash64(id_col), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores per query with their rank, ties to the smaller vec_id; cut to k per task before the shuffle as well."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_blocks(rows: DataFrame, queries: DataFrame, keys: list[str], top: Callable, kind: str, k: int) -> DataFrame:
    """Rows and queries that meet under ``keys``: ``top(queries, rows)`` per block pair, then the best ``k`` of each query.

    Both tables carry id, the columns that ``top`` reads, and ``keys``, which the caller makes so that a block is small enough for one task.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return top(left, right) if len(left) and len(right) else empty

    met = queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(run, f"query_id long, vec_id long, score {kind}")
    return best(met, k)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)
