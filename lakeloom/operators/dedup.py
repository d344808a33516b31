"""Exact and near duplicates of texts, without ever listing all pairs of a group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import tokens
from lakeloom.plans import durable, grouped, skew
from lakeloom.plans.components import components


def content_key(text: Column) -> Column:
    """Digest of the text with case and blanks levelled."""
    return F.sha2(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), 256)


def exact_copies(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every row with the lowest id among its exact copies."""
    hashed = durable.cut(df.select(key, content_key(F.col(text)).alias("__h")), "hashed")
    first = durable.cut(hashed.groupBy("__h").agg(F.min(key).alias("keep_id"), F.count("*").alias("__n")), "first")
    return skew.uneven_join(hashed.filter("__h IS NOT NULL"), first.filter("__h IS NOT NULL"), ["__h"], "__n").select(key, "keep_id")


def shingles(words: Column, k: int = 3) -> Column:
    """Distinct hashes of the k-word runs; shorter texts are one shingle.

    ``words`` must be a plain column: an expression would be evaluated again for every run.
    """
    n = F.greatest(F.size(words) - k + 1, F.lit(1))
    # single elements are read in place, while a slice would copy the whole list for every run
    runs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.array_distinct(runs)


BUCKET_ROWS = 500


def _links(buckets: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (leader, id, jaccard) that connect whatever is connected within a bucket.

    All members of a bucket are compared with each other inside a task, a large bucket in pairs of parts, so every link is seen and
    the number of rounds is one. Of the links of a task only those that hold its groups together leave it, one per text at most.
    """
    crowded = buckets.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    members = buckets.join(crowded, "bucket").join(sets, "id")
    dealt = grouped.in_blocks(members, "bucket", "id", "m", BUCKET_ROWS).select("group", "id", "set")

    def connect(table: pa.Table) -> pa.RecordBatch | None:
        ids, first = np.unique(table.column("id").to_numpy(), return_index=True)
        held = [table.column("set")[int(i)].values.to_numpy() for i in first]
        size = np.array([len(s) for s in held])
        shared = grouped.overlaps(held)
        jaccard = shared / (size[:, None] + size[None, :] - shared)
        linked = jaccard >= threshold
        np.fill_diagonal(linked, False)
        _, parent = grouped.first_connected(linked)
        far = np.flatnonzero(parent != np.arange(len(ids)))
        if not len(far):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[parent[far]]), pa.array(ids[far]), pa.array(jaccard[parent[far], far])], ["leader", "id", "jaccard"])

    return dealt.repartition("group").sortWithinPartitions("group").mapInArrow(
        grouped.by_group(connect), "leader long, id long, jaccard double")


def near_duplicate_links(df: DataFrame, key: str, text: str, threshold: float = 0.85, bands: int = 16, rows: int = 4) -> DataFrame:
    """Verified links (leader, id, jaccard) between texts whose shingle sets overlap enough.

    Candidates share a MinHash band; exact copies are folded into one text first. Every link is
    checked with the exact Jaccard value of the whole texts.
    """
    worded = df.select(F.col(key).alias("id"), content_key(F.col(text)).alias("__h"), tokens(F.col(text)).alias("__words"))
    base = worded.select("id", "__h", shingles(F.col("__words")).alias("set"))
    unique = skew.latest_per_key(base, ["__h"], [F.asc("id")]).select("id", "set")
    sets = durable.cut(unique, "sets")
    each = sets.select("id", F.explode("set").alias("s"))
    mins = each.groupBy("id").agg(*[F.min(F.xxhash64("s", F.lit(i))).alias(f"m{i}") for i in range(bands * rows)])
    keys = F.array(*[F.xxhash64(F.lit(b), *[f"m{b * rows + r}" for r in range(rows)]) for b in range(bands)])
    buckets = durable.cut(mins.select("id", F.explode(keys).alias("bucket")), "buckets")
    return _links(buckets, sets, threshold).groupBy("leader", "id").agg(F.max("jaccard").alias("jaccard"))


def near_duplicate_groups(df: DataFrame, key: str, text: str, threshold: float = 0.85) -> DataFrame:
    """(key, group) with the lowest id of the group, for every row that has an exact or near duplicate."""
    copies = exact_copies(df, key, text).filter(F.col(key) != F.col("keep_id"))
    links = near_duplicate_links(df, key, text, threshold).select(F.col("leader").alias("a"), F.col("id").alias("b"))
    edges = links.unionByName(copies.select(F.col("keep_id").alias("a"), F.col(key).alias("b")))
    return components(edges).select(F.col("node").alias(key), F.col("root").alias("group_id"))
