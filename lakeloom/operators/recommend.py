"""Exact best items per user from two factor tables, without scoring all pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import durable

ITEMS_PER_CHUNK, USERS_PER_BLOCK = 4096, 8192
FOUND = "user long, item long, score double"


def top_items(users: DataFrame, items: DataFrame, k: int, counted: list[int] | None = None) -> DataFrame:
    """(user, item, score, rank): the ``k`` items of largest inner product per user, ties to the smaller item; tables are (id, features).

    Items are cut into chunks by falling length of their vector. |u| |v| bounds an inner product, so a user is done once the k-th score
    found is above |u| times the longest vector left. Chunks are taken in rounds of 1, 2, 4, ...; in a round the users still open
    meet its chunks in blocks, and a block pair is one task's work. ``counted`` receives the pairs scored in each round.

    NULL ids and vectors are left out; a user with fewer than ``k`` items gets all of them.
    """
    spark = users.sparkSession
    fine = F.col("id").isNotNull() & F.col("features").isNotNull()
    length = F.sqrt(F.aggregate(F.transform("features", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, x: a + x))
    state = durable.cut(users.filter(fine).select(F.col("id").cast("long").alias("user"), "features", length.alias("length")), "users")
    chunks = max(1, -(-items.count() // ITEMS_PER_CHUNK))
    sorted_items = items.filter(fine).select(F.col("id").cast("long").alias("item"), "features", length.alias("length"))
    laid = durable.cut(sorted_items.repartitionByRange(chunks, F.desc("length"), "item").withColumn("chunk", F.spark_partition_id()), "items")
    longest = {r.chunk: r.m for r in laid.groupBy("chunk").agg(F.max("length").alias("m")).collect()}
    order = sorted(longest)
    best = spark.createDataFrame([], FOUND)
    at, wide = 0, 1
    while at < len(order):
        some, at, wide = order[at:at + wide], at + wide, wide * 2
        blocks = F.greatest(F.lit(1), F.ceil(state.agg(F.count("*")).scalar() / USERS_PER_BLOCK)).cast("int")
        asked = state.withColumn("block", F.pmod(F.xxhash64("user"), blocks).cast("int")).withColumn(
            "chunk", F.explode(F.array(*[F.lit(c) for c in some])))
        offered = laid.filter(F.col("chunk").isin(some)).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        met = asked.groupBy("block", "chunk").cogroup(offered.groupBy("block", "chunk")).applyInPandas(_scored(k), FOUND)
        best = durable.cut(_best(best.unionByName(met), k), "best")
        if counted is not None:
            counted.append(state.count() * laid.filter(F.col("chunk").isin(some)).count())
        if at < len(order):
            kth = best.groupBy("user").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
            bound = F.col("length") * longest[order[at]] * (1 + 1e-12)
            state = durable.cut(state.join(kth, "user", "left").filter((F.coalesce("n", F.lit(0)) < k) | (F.col("kth") <= bound)).select(
                "user", "features", "length"), "open")
            if state.isEmpty():
                break
    return _best(best, k, "rank")


def _best(found: DataFrame, k: int, name: str = "") -> DataFrame:
    from lakeloom.plans import skew

    top = skew.top_per_key(found, ["user"], [F.desc("score"), F.asc("item")], k, name or "rank")
    return top if name else top.drop("rank")


def _scored(k: int):
    def run(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(offered):
            return pd.DataFrame({"user": [], "item": [], "score": []})
        return pd.concat(_parts(asked, offered.sort_values("item"), k))

    return run


def _parts(asked: pd.DataFrame, offered: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    """The k best of a chunk for a thousand users at a time; items ascend, so equal scores keep the smaller item."""
    v = np.stack(offered["features"].to_numpy()).astype(np.float64)
    item = offered["item"].to_numpy()
    for a in range(0, len(asked), 1000):
        u = np.stack(asked["features"].iloc[a:a + 1000].to_numpy()).astype(np.float64)
        score = u @ v.T
        top = np.argsort(-score, axis=1, kind="stable")[:, :k]
        yield pd.DataFrame({"user": np.repeat(asked["user"].to_numpy()[a:a + 1000], top.shape[1]), "item": item[top].ravel(),
                            "score": np.take_along_axis(score, top, 1).ravel()})
