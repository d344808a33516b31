"""Joins and selections that stay even under a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 2**20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df``, from file sizes and the plan; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_bytes(df: DataFrame) -> int:
    """Rows, counted, times the width of their types: what ``df`` holds in memory, however well its files are compressed."""
    return df.count() * df._jdf.schema().defaultSize()


def checked_broadcast(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only where the estimated size is bounded; otherwise adaptive execution chooses the join by the real size."""
    return F.broadcast(df) if estimated_bytes(df) <= most else df


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    row_id: Sequence[str],
    salts: int = 16,
    how: str = "inner",
) -> DataFrame:
    """Equi-join whose hot keys are spread over ``salts`` tasks.

    The salt is a hash of the row id, so a retried task sends each row to the same place. Valid for
    ``inner``, ``left`` and ``left_semi``, where every big row still meets each match once. The optimizer's estimate of the small side
    neither counts its ``salts`` copies nor knows how far its files are compressed, so where a broadcast is planned by it, the rows are counted, and
    copies that are too many to be broadcast are exchanged.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"salting does not keep {how} joins intact")
    left = big.withColumn("__salt", F.pmod(F.xxhash64(*row_id), F.lit(salts)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    once, most = estimated_bytes(small), small.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if once <= most and max(once, row_bytes(small)) * salts > min(most, BROADCAST_BYTES):
        right = right.hint("merge")
    return left.join(right, [*on, "__salt"], how).drop("__salt")


HEADS = 10_000


def uneven_join(big: DataFrame, small: DataFrame, on: Sequence[str], count: str, apart: bool = False,
                heads: int | None = None) -> DataFrame:
    """Inner equi-join with a table of one row per key that also carries how often the key occurs in ``big``.

    Keys with more than 1/``heads`` (HEADS, if not given) of all occurrences, of which there are at most ``heads``, travel to the rows; only rows of the others are exchanged,
    so no task gets a hot key. ``small`` is read three times: write it first where it is costly. NULL keys match nothing. Set ``apart`` if the
    result is grouped: the rest is then exchanged however small it is, else a union of two parts that look alike partitioned is grouped without an
    exchange, which splits groups when adaptive execution has merged their partitions differently.
    """
    total = small.agg(F.sum(count)).scalar()
    often = F.col(count) * (heads or HEADS) > total
    hot, cold = F.broadcast(small.filter(often)), small.filter(~often)
    left = big.join(F.broadcast(small.filter(often).select(*on)), list(on), "left_anti")
    return big.join(hot, list(on)).unionByName(left.join(cold.hint("merge") if apart else cold, list(on)))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``.

    The rank filter is applied before the shuffle as well, so a hot key sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).filter("__rn = 1").drop("__rn")


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rn"
) -> DataFrame:
    """First ``n`` rows per key, numbered; cut to ``n`` per key before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, rank).filter(F.col(name) <= n)
