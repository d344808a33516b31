"""Tuple sketches: a bottom-k sample of items by hash with a summed payload, for distinct counts, sums and set operations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ONE = 2**63 - 1  # hashes are 0 .. ONE; as theta it says that every item is in the sketch
HELD = 500_000  # entries that a task holds before it hands them on


def tuple_sketch(df: DataFrame, keys: Sequence[str], item: Column, payload: Column, k: int = 4096) -> DataFrame:
    """(keys, h, total, theta): the ``k`` items of smallest hash per group with the sum of their payload, in one pass.

    A task keeps the k + 1 smallest hashes per group that it has seen; an item of the whole group's sketch is always among them, so its sum
    is complete, and a task sends at most k + 1 entries per group and ``HELD`` rows. ``theta`` is the first hash left out, or ``ONE``
    if none is. NULL items are left out, a NULL payload counts as 0. Sketches of equal ``k`` can be merged and compared.
    """
    names = list(keys)
    rows = df.select(*names, F.shiftrightunsigned(F.xxhash64(item), 1).alias("h"), F.coalesce(payload.cast("double"), F.lit(0.0)).alias("total"),
                     item.isNotNull().alias("__fine")).filter("__fine").drop("__fine")

    def smallest(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.groupby([*names, "h"], dropna=False, as_index=False)["total"].sum()
        return frame.sort_values("h").groupby(names, dropna=False).head(k + 1) if names else frame.nsmallest(k + 1, "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        schema = None
        for batch in batches:
            schema = batch.schema
            held.append(smallest(batch.to_pandas(types_mapper=pd.ArrowDtype)))
            if sum(map(len, held)) > HELD:
                held = [smallest(pd.concat(held))]
                if len(held[0]) > HELD // 2:
                    yield pa.RecordBatch.from_pandas(held.pop(), schema, preserve_index=False)
        if held:
            yield pa.RecordBatch.from_pandas(smallest(pd.concat(held)), schema, preserve_index=False)

    entries = rows.mapInArrow(run, rows.schema)
    return _trimmed(entries.groupBy(*names, "h").agg(F.sum("total").alias("total")), names, k, F.lit(ONE))


def _trimmed(entries: DataFrame, keys: Sequence[str], k: int, theta: Column) -> DataFrame:
    """The k smallest per group; what follows the rank filter sees k + 1 rows of a group."""
    order = Window.partitionBy(*keys).orderBy("h")
    few = entries.withColumn("__theta", theta).withColumn("__rn", F.row_number().over(order)).filter(F.col("__rn") <= k + 1)
    first_out = F.max(F.when(F.col("__rn") == k + 1, F.col("h"))).over(Window.partitionBy(*keys))
    cut = few.withColumn("theta", F.least(F.coalesce(first_out, F.lit(ONE)), "__theta"))
    return cut.filter("h < theta OR theta = 9223372036854775807").drop("__rn", "__theta")


def merged(sketch: DataFrame, keys: Sequence[str], k: int = 4096) -> DataFrame:
    """Sketches joined over coarser ``keys``: that of the union of their rows."""
    bound = Window.partitionBy(*keys)
    below = sketch.withColumn("__least", F.min("theta").over(bound)).filter("h < __least OR __least = 9223372036854775807")
    entries = below.groupBy(*keys, "h").agg(F.sum("total").alias("total"), F.min("__least").alias("__least"))
    return _trimmed(entries, keys, k, F.col("__least"))


def _share(theta: Column) -> Column:
    return F.when(theta == ONE, 1.0).otherwise(theta / 2.0**63)


def estimates(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, items, total, error): distinct items and payload of all of them; ``error`` is the relative standard error of ``items``, 0 if exact."""
    share = F.min(_share(F.col("theta")))
    n = F.count("*")
    return sketch.groupBy(*keys).agg(
        (n / share).alias("items"), (F.sum("total") / share).alias("total"),
        F.when(share < 1, F.sqrt((1 - share) / F.greatest(n - 1, F.lit(1)))).otherwise(0.0).alias("error"))


def compared(sketch: DataFrame, group: str) -> DataFrame:
    """For each two groups a < b: items in both, in either and in a alone, and the payload that items in both have on either side.

    Sketches meet on the hash, so a pair of groups costs at most k rows; groups without a common item have no row.
    """
    a = sketch.select(F.col(group).alias("a"), "h", F.col("total").alias("total_a"), F.col("theta").alias("theta_a"))
    b = sketch.select(F.col(group).alias("b"), "h", F.col("total").alias("total_b"), F.col("theta").alias("theta_b"))
    both = a.join(b, "h").filter("a < b AND (h < least(theta_a, theta_b) OR least(theta_a, theta_b) = 9223372036854775807)")
    least = F.min(F.least(_share(F.col("theta_a")), _share(F.col("theta_b"))))
    shared = both.groupBy("a", "b").agg(
        (F.count("*") / least).alias("in_both"), (F.sum("total_a") / least).alias("total_a_in_both"), (F.sum("total_b") / least).alias("total_b_in_both"))
    sizes = estimates(sketch, [group]).select(F.col(group).alias("g"), "items")
    sized = shared.join(sizes.select(F.col("g").alias("a"), F.col("items").alias("items_a")), "a").join(
        sizes.select(F.col("g").alias("b"), F.col("items").alias("items_b")), "b")
    return sized.select("a", "b", "in_both", (F.col("items_a") + F.col("items_b") - F.col("in_both")).alias("in_either"),
                        (F.col("items_a") - F.col("in_both")).alias("only_a"), "total_a_in_both", "total_b_in_both")
