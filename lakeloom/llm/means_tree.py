"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.vectors import QUERIES_PER_BLOCK, ROWS_PER_BLOCK, best, blocks, matrix, search_blocks, share, usable
from lakeloom.plans import durable


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(centres, nearest centre of each row) by Lloyd's rounds from spread starts."""
    centres = x[rng.integers(len(x))][None]
    far = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k and far.max() > 0:
        centres = np.vstack([centres, x[rng.choice(len(x), p=far / far.sum())]])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(1))
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, 1)
        size = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres, np.argmin((centres**2).sum(1) - 2 * x @ centres.T, 1)


@dataclass
class Tree:
    """``centre``: by node; ``children``: (first, last + 1) of each node, equal for a leaf; node 0 is the root."""

    centre: np.ndarray
    children: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, branching: int = 8, leaf_rows: int = 64, seed: int = 7) -> Tree:
        rng = np.random.default_rng(seed)
        centre, children, waiting = [x.mean(0)], [(0, 0)], [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop(0)
            if len(rows) <= leaf_rows:
                continue
            centres, near = _means(x[rows], branching, rng)
            parts = [rows[near == j] for j in range(len(centres))]
            kept = [(c, p) for c, p in zip(centres, parts) if len(p)]
            if len(kept) < 2:
                continue
            children[node] = (len(centre), len(centre) + len(kept))
            for c, p in kept:
                waiting.append((len(centre), p))
                centre.append(c)
                children.append((0, 0))
        return Tree(np.array(centre), np.array(children))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf reached by going to the nearest child, for each row."""
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.children[at, 1] > 0)
            if not len(inner):
                return at
            for node in np.unique(at[inner]):
                rows = inner[at[inner] == node]
                a, b = self.children[node]
                c = self.centre[a:b]
                at[rows] = a + np.argmin((c**2).sum(1) - 2 * x[rows] @ c.T, 1)

    def visits(self, q: np.ndarray, n_leaves: int, held: dict[int, int], least_rows: int) -> list[int]:
        """Leaves in the order of a priority queue over the nodes met so far, the largest product with a centre first.

        Goes on until ``n_leaves`` leaves with rows have been visited and they hold ``least_rows`` rows.
        """
        score = self.centre @ q
        queue, out, rows = [(0.0, 0)], [], 0
        while queue and (len(out) < n_leaves or rows < least_rows):
            node = heapq.heappop(queue)[1]
            a, b = self.children[node]
            for child in range(a, b):
                heapq.heappush(queue, (-score[child], child))
            if a == b and held.get(node):
                out.append(node)
                rows += held[node]
        return out


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, so that equal vectors get equal scores wherever they lie."""
    return np.cumsum(x * q, axis=1)[:, -1]


def top(queries: pd.DataFrame, rows: pd.DataFrame, k: int, pairs: int = 65_536) -> pd.DataFrame:
    """The ``k`` best of ``rows`` for each query; a fast product chooses the candidates, ``exact_scores`` ranks them, ``pairs`` at a time."""
    q, x, query_ids, ids = matrix(queries["v"]), matrix(rows["v"]), queries["id"].to_numpy(), rows["id"].to_numpy()
    slack = 1e-11 * np.sqrt((x**2).sum(1)).max() * np.sqrt((q**2).sum(1))
    out = []
    for start in range(0, len(q), 128):
        rough = q[start:start + 128] @ x.T
        rough[query_ids[start:start + 128, None] == ids] = -np.inf
        floor = np.partition(rough, len(x) - k, axis=1)[:, len(x) - k] if len(x) > k else np.full(len(rough), -np.inf)
        of, at = np.nonzero((rough >= (floor - slack[start:start + 128])[:, None]) & (rough > -np.inf))
        of += start
        exact = np.concatenate([np.empty(0), *(exact_scores(q[of[i:i + pairs]], x[at[i:i + pairs]]) for i in range(0, len(of), pairs))])
        order = np.lexsort((ids[at], -exact, of))
        of, at, exact = of[order], at[order], exact[order]
        kept = np.arange(len(of)) - np.searchsorted(of, of) < k
        out.append(pd.DataFrame({"query_id": query_ids[of[kept]], "vec_id": ids[at[kept]], "score": exact[kept]}))
    return pd.concat(out)


@dataclass
class Index:
    tree: Tree | None
    rows: DataFrame
    held: dict[int, int]
    n_leaves: int
    recall: float


def build(rows: DataFrame, k: int = 20, target: float = 0.97, sample_rows: int = 20_000, calibration: int = 96, branching: int = 8,
          leaf_rows: int = 64) -> Index:
    """The tree, every row with its leaf, and the number of leaves to visit.

    ``rows`` are (id, v) of ``usable``. The tree is fitted on at most ``sample_rows`` rows, those with the smallest hash; every row is put into a
    leaf. ``calibration`` rows are searched by brute force over all rows, and the number of visited leaves grows until they
    find the share ``target`` of their true neighbours. Both bounds are parameters and do not grow with the table.
    """
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toPandas()
    if picked.empty:
        return Index(None, rows, {}, 0, 1.0)
    tree = Tree.fit(matrix(picked["v"]), branching, leaf_rows)

    def place(batches):
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.leaf_of(matrix(batch["v"])))

    placed = durable.cut(rows.mapInPandas(place, "id long, v array<double>, leaf long"), "leaves")
    held = {r[0]: r[1] for r in placed.groupBy("leaf").count().collect()}  # one row per leaf, of which there are few
    tests = picked.tail(calibration)

    def brute(batches):
        for batch in batches:
            if len(batch):
                found = top(tests, batch, k)
                yield found.merge(batch[["id", "leaf"]], left_on="vec_id", right_on="id")[["query_id", "vec_id", "score", "leaf"]]

    found = placed.mapInPandas(brute, "query_id long, vec_id long, score double, leaf long")
    true = best(found.withColumn("vec_id", F.struct("vec_id", "leaf")), k).select("query_id", "vec_id.leaf").toPandas()
    order = {i: {leaf: n for n, leaf in enumerate(tree.visits(v, len(held), held, 0), 1)} for i, v in zip(tests["id"], matrix(tests["v"]))}
    needed = np.sort([order[i][leaf] for i, leaf in zip(true["query_id"], true["leaf"])])
    if not len(needed):
        return Index(tree, placed, held, 1, 1.0)
    n_leaves = 1
    while np.searchsorted(needed, n_leaves, "right") < target * len(needed):
        n_leaves += 1
    return Index(tree, placed, held, n_leaves, float(np.searchsorted(needed, n_leaves, "right") / len(needed)))


def nearest(table: DataFrame, k: int = 20, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``query_every`` the ``k`` largest inner products found.

    Candidates are all rows but the query's own, scores are in double precision, ties go to the smaller id; a query gets ``k`` rows if
    there are as many candidates. ``options`` are those of ``build``. Rows of a leaf are dealt over blocks by a hash of their id, and so are the
    queries that visit it, so neither a popular leaf nor a vector that is there very often has to fit into a task.

    Vectors that are null, zero or hold null, NaN or infinite components take no part; see ``usable`` for repeated and null ids and odd
    lengths. An empty table gives an empty result.
    """
    rows = usable(table, id_col, vector_col, zero_too=False)
    index = build(rows, k, **options)
    tree, held, n_leaves = index.tree, index.held, index.n_leaves
    if tree is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    n_queries = index.rows.filter(F.col("id") % query_every == 0).count()
    parts = {leaf: blocks(n, ROWS_PER_BLOCK) for leaf, n in held.items()}
    share_of_leaves = min(1.0, n_leaves / max(1, len(held)))
    query_parts = blocks(int(n_queries * share_of_leaves), QUERIES_PER_BLOCK)

    def plan(batches):
        for batch in batches:
            out = []
            for i, v in zip(batch["id"], matrix(batch["v"]) if len(batch) else []):
                for leaf in tree.visits(v, n_leaves, held, k + 1):
                    out += [(i, v, leaf, part) for part in range(parts[leaf])]
            yield pd.DataFrame(out, columns=["id", "v", "leaf", "rb"])

    queries = index.rows.filter(F.col("id") % query_every == 0).select("id", "v").mapInPandas(
        plan, "id long, v array<double>, leaf long, rb int")
    queries = queries.withColumn("qb", share("id", query_parts))
    sizes = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
    dealt = index.rows.select("id", "v", "leaf", share("id", sizes[F.col("leaf")]).alias("rb"),
                              F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))).alias("qb"))
    return search_blocks(dealt, queries, ["leaf", "rb", "qb"], lambda q, x: top(q, x, k), "double", k)
