"""Centroid clustering whose assignment is bounded by Ptolemy's inequality over fixed pivots."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import durable

EPS = 2.0**-48  # more than all roundings of one bound together, as a share
LONGEST = 2**63 - 1


def plain(dims: int) -> int:
    """Components up to here keep every squared distance of ``dims`` of them within a long."""
    return math.isqrt(LONGEST // (4 * dims))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit integers where those are exact, else Python integers of any size."""
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    if not y.size or np.abs(y).max() <= plain(x.shape[1]):
        return y.astype(np.int64)
    out = np.empty(x.shape, object)
    out.ravel()[:] = [int(v) if math.isfinite(v) else scale * int(u) for v, u in zip(y.ravel().tolist(), x.ravel().tolist())]
    return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    if a.dtype != b.dtype:
        a, b = a.astype(object), b.astype(object)
    d = a - b
    return (d * d).sum(1)


def root(d: np.ndarray) -> np.ndarray:
    """Square roots as doubles, infinite where they exceed them."""
    if d.dtype != object:
        return np.sqrt(d.astype(np.float64))
    return np.array([math.sqrt(v) if v < 10**300 else math.inf for v in d.tolist()], np.float64)


def at_least(d: np.ndarray) -> np.ndarray:
    """Doubles that are no smaller than the integers ``d``."""
    if d.dtype == object:
        d = np.array([float(v) if v < 10**300 else math.inf for v in d.tolist()], np.float64)
    return np.nextafter(d.astype(np.float64), np.inf)


def matrix(rows: list[list[int]]) -> np.ndarray:
    return np.array(rows, np.int64 if max(abs(v) for r in rows for v in r) <= plain(len(rows[0])) else object)


@dataclass
class Centroids:
    """The centroids of a round with their distances to the pivots, which stay the same through all rounds."""

    at: np.ndarray
    pivots: np.ndarray

    def __post_init__(self):
        self.to_pivots = np.stack([root(squared(self.at, np.repeat(p[None], len(self.at), 0))) for p in self.pivots], 1)
        self.between = np.stack([root(squared(self.pivots, np.repeat(p[None], len(self.pivots), 0))) for p in self.pivots], 1)

    def bounds(self, cached: np.ndarray) -> np.ndarray:
        """(rows, centroids): numbers that no squared distance is below, from the rows' cached distances to the pivots.

        Ptolemy: d(q,c) d(s,t) >= |d(q,s) d(c,t) - d(q,t) d(c,s)|. Products are widened by more than their rounding before they are
        subtracted, quotient and square are rounded down; what is not a number bounds nothing.
        """
        best = np.zeros((len(cached), len(self.at)))
        with np.errstate(all="ignore"):
            for s in range(len(self.pivots)):
                for t in range(s + 1, len(self.pivots)):
                    if not self.between[s, t] > 0:
                        continue
                    a = cached[:, s, None] * self.to_pivots[None, :, t]
                    b = cached[:, t, None] * self.to_pivots[None, :, s]
                    gap = (np.abs(a - b) - EPS * (a + b)) / self.between[s, t]
                    np.fmax(best, np.where(np.isfinite(gap), gap, 0), out=best)
            bound = best * best * (1 - EPS)
            return np.where(np.isfinite(bound), bound, 0)

    def nearest(self, rows: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(centroid, exact squared distance) of each row, ties to the smaller number, and how many distances were computed.

        The centroid of the lowest bound is measured first; of the others those that the bound does not exclude.
        """
        every = np.arange(len(rows))
        bound = self.bounds(cached)
        cluster = bound.argmin(1)
        distance = squared(rows, self.at[cluster])
        least = at_least(distance)
        left = ~(bound > least[:, None])
        left[every, cluster] = False
        row, other = np.nonzero(left)
        measured = len(rows) + len(row)
        found = squared(rows[row], self.at[other])
        # numbers of the centroids ascend within a row, so the first of equal distances is the smallest; it may still be above the start's
        for c in range(len(self.at)):
            mine = np.flatnonzero(other == c)
            r, d = row[mine], found[mine]
            if d.dtype != distance.dtype:
                d, distance = d.astype(object), distance.astype(object)
            better = (d < distance[r]) | ((d == distance[r]) & (c < cluster[r]))
            cluster[r[better]], distance[r[better]] = c, d[better]
        return cluster, distance, measured


def kept_vectors(table: DataFrame, dims: int) -> DataFrame:
    """(vec_id, x): vectors of exactly ``dims`` components, none null or not finite."""
    x = F.col("x")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    return rows.filter((F.size(x) == dims) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[float]]:
    """The vectors of the ``k`` smallest digests of ``seed:vec_id``, equal digests by their components; rows without vec_id start none."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    picked = rows.filter(F.col("vec_id").isNotNull()).withColumn("h", digest).orderBy("h", "x").limit(k)
    return [list(r.x) for r in picked.select("x").collect()]


def _vectors(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _parts(batches: Iterator[pa.RecordBatch], most: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, most):
            yield batch.slice(a, most)


def with_pivot_distances(rows: DataFrame, pivots: np.ndarray, dims: int, scale: int) -> DataFrame:
    """(vec_id, x, p): the distances to all pivots, computed once and written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            v = integers(_vectors(batch, "x", dims), scale)
            p = np.stack([root(squared(v, np.repeat(q[None], len(v), 0))) for q in pivots], 1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), pa.array(list(p), pa.list_(pa.float64()))],
                                             ["vec_id", "x", "p"])

    return durable.cut(rows.mapInArrow(run, "vec_id long, x array<double>, p array<double>"), "pivots")


SUMS = "cluster int, part int, n long, measured long, sums array<string>"


def cluster_sums(rows: DataFrame, centroids: Centroids, dims: int, scale: int, parts: int = 64) -> dict[int, tuple[int, int, list[int]]]:
    """(rows, distances computed, componentwise sums) of each cluster under ``centroids``.

    A task sums its rows and gives one row per cluster; these meet in ``parts`` groups of a cluster first, then in one. Sums are Python
    integers, written as text, so none overflows.
    """

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, list] = {}
        for batch in _parts(batches):
            v = integers(_vectors(batch, "x", dims), scale)
            cluster, _, measured = centroids.nearest(v, _vectors(batch, "p", len(centroids.pivots)))
            for c in np.unique(cluster).tolist():
                mine = v[cluster == c]
                n, m, sums = held.get(c, (0, 0, [0] * dims))
                held[c] = n + len(mine), m + measured, [a + int(b) for a, b in zip(sums, mine.sum(0).tolist())]
                measured = 0
        part = TaskContext.get().partitionId() % parts
        yield _row_batch([(c, part, *of) for c, of in held.items()])

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        sums = [str(sum(map(int, column))) for column in zip(*frame["sums"])]
        return pd.DataFrame({"cluster": frame["cluster"].iloc[:1], "part": frame["part"].iloc[:1], "n": [frame["n"].sum()],
                             "measured": [frame["measured"].sum()], "sums": [sums]})

    found = rows.mapInArrow(assign, SUMS).groupBy("cluster", "part").applyInPandas(total, SUMS)
    found = found.withColumn("part", F.lit(0)).groupBy("cluster").applyInPandas(total, SUMS)
    return {r.cluster: (r.n, r.measured, [int(v) for v in r.sums]) for r in found.collect()}


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    cluster, part, n, measured, sums = zip(*rows) if rows else ([],) * 5
    return pa.RecordBatch.from_arrays([
        pa.array(cluster, pa.int32()), pa.array(part, pa.int32()), pa.array(n, pa.int64()), pa.array(measured, pa.int64()),
        pa.array([list(map(str, s)) for s in sums], pa.list_(pa.string()))], ["cluster", "part", "n", "measured", "sums"])


def assigned(rows: DataFrame, centroids: Centroids, dims: int, scale: int) -> DataFrame:
    """(vec_id, cluster, distance); squared distances beyond a long are given as the largest long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            v = integers(_vectors(batch, "x", dims), scale)
            cluster, distance, _ = centroids.nearest(v, _vectors(batch, "p", len(centroids.pivots)))
            distance = np.minimum(distance, LONGEST).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                                             ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def clusters(table: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, pivots: int = 6,
             computed: list[float] | None = None) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector of ``embedding`` with exactly ``dims`` components.

    Components become floor(scale * x). Centroids start as the ``k`` vectors of the smallest digests of ``seed:vec_id`` (fewer, if there are
    fewer); each round assigns every vector to the nearest one, ties to the smaller number, and moves every centroid that has vectors to
    floor(sum / count) of them. All arithmetic that decides is exact, in 64-bit or, for huge components, in Python integers.

    The first ``pivots`` starting centroids stay as pivots: every vector's distances to them are computed once and written, and in every
    round they bound its distances to all centroids from below; only centroids that the bound does not exclude are measured.

    Vectors that are null, of another length, or hold null or non-finite components take no part. Rows that share a vec_id count each; those
    with a null one are clustered but start no centroid. A squared distance or sum of them beyond a long is given as the largest long. An
    empty table gives an empty result. Other columns are not read. ``computed`` receives, per round, the share of distances that was measured.
    """
    spark = table.sparkSession
    rows = kept_vectors(table, dims)
    first = first_centroids(rows, k, seed)
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    at = [integers(np.array([v], np.float64), scale)[0].tolist() for v in first]
    fixed = matrix(at[:pivots])
    rows = with_pivot_distances(rows, fixed, dims, scale)
    for _ in range(rounds):
        sums = cluster_sums(rows, Centroids(matrix(at), fixed), dims, scale)
        for c, (n, _, total) in sums.items():
            at[c] = [v // n for v in total]
        if computed is not None:
            computed.append(sum(m for _, m, _ in sums.values()) / (len(at) * sum(n for n, _, _ in sums.values())))
    found = durable.cut(assigned(rows, Centroids(matrix(at), fixed), dims, scale), "assigned")
    named = spark.createDataFrame([(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(at)],
                                  "cluster int, centroid_sha256 string")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = found.groupBy("cluster").agg(exact.alias("s")).join(named, "cluster")
    per = per.select("cluster", _long("s").alias("cluster_inertia"), "centroid_sha256")
    whole = found.agg(exact.alias("s")).select(_long("s").alias("inertia"))
    # one row per centroid, so their number bounds what is sent
    return found.join(F.broadcast(per), "cluster").withColumn("inertia", whole.scalar()).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(name: str):
    return F.least(F.col(name), F.lit(LONGEST)).cast("long")
