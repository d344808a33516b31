"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import durable


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of ``links`` with the smallest node it is connected to.

    Alternates two steps until nothing changes: each node hangs its larger neighbours on its smallest one, then its smaller
    neighbours and itself on the smallest of those. Both shrink a chain of n links by halving, so rounds grow with log(n). A hub
    sends one partial minimum per task and its links are joined with that minimum, which adaptive execution may split. Links with
    a null end or with equal ends say nothing and are left out; an empty table gives an empty result.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    path, edges = _written(edges)
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        mid_path, large = _written(large)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        small = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v"))).distinct()
        new_path, small = _written(small)
        state = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
                          F.count_if(F.col("u") <= F.col("v")).alias("bad")).first()
        durable.discard(spark, path)
        durable.discard(spark, mid_path)
        path, edges = new_path, small
        if before == state:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _written(df: DataFrame) -> tuple[str, DataFrame]:
    path = durable.scratch_dir(df.sparkSession, "links")
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)
