"""Exact top-k inner products through a vector-approximation file."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.vectors import QUERIES_PER_BLOCK, ROWS_PER_BLOCK, blocks, matrix, search_blocks, share, usable
from lakeloom.plans import durable

EXACT = 2.0**53


def bounds(q: np.ndarray, cells: np.ndarray, low: float, width: float) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bound of each query's inner product with each row, from the rows' cells alone."""
    least = low + cells.astype(np.float64) * width
    most = least + (width - 1)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ least.T + down @ most.T, up @ most.T + down @ least.T


def refine(q: np.ndarray, rows: np.ndarray, ids: np.ndarray, lower: np.ndarray, upper: np.ndarray, k: int, step: int = 64):
    """(places, scores) of one query's ``k`` best rows, ties to the smaller id.

    Exact vectors are read in the order of their upper bounds (the lower bound of a distance), until no unread row can reach the kth score.
    """
    n = len(ids)
    floor = np.partition(lower, n - k)[n - k] if n > k else -np.inf
    order = np.flatnonzero((upper >= floor) & (upper > -np.inf))
    order = order[np.argsort(-upper[order], kind="stable")]
    at, score = np.empty(0, np.int64), np.empty(0)
    for i in range(0, len(order), step):
        if len(at) == k and upper[order[i]] < score[-1]:
            break
        more = order[i:i + step]
        at, score = np.concatenate([at, more]), np.concatenate([score, rows[more] @ q])
        keep = np.lexsort((ids[at], -score))[:k]
        at, score = at[keep], score[keep]
    return at, score


def exact_top_k(rows: DataFrame, k: int = 10, query_every: int = 100, scale: float = 1024, bits: int = 6, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``query_every`` the ``k`` highest inner products.

    Components x count as floor(scale * x). Candidates are all rows but the query's own; fewer than ``k`` give all; ties go to the
    smaller id. The file holds for each vector a cell of ``bits`` bits per component beside the exact numbers; within a block the cells give
    bounds for every row and exact numbers are read only where a bound can still reach the kth score. Queries meet all rows in
    blocks, so nothing is sent whole to one task.

    Vectors that are null or hold null, NaN or infinite components take no part; see ``usable`` for repeated and null ids and odd lengths.
    Where products can pass 2^53 they are computed with integers of any size and held within the range of a long. An
    empty table gives an empty result.
    """
    table = usable(rows, id_col, vector_col, zero_too=True).select(
        "id", F.transform("v", lambda x: x * scale).alias("x"))
    ends = table.agg(F.min(F.array_min("x")), F.max(F.array_max("x")), F.count("*"), F.max(F.size("x")),
                     F.count_if(F.col("id") % query_every == 0)).first()
    low, high = np.floor([float(ends[0] or 0), float(ends[1] or 0)])
    width = max(1.0, np.ceil((high - low + 1) / 2**bits))
    exact = max(low * low, high * high) * max(ends[3] or 1, 1) < EXACT
    row_parts, query_parts = blocks(ends[2], ROWS_PER_BLOCK), blocks(ends[4], QUERIES_PER_BLOCK)

    def approximate(batches):
        for batch in batches:
            x = np.floor(matrix(batch["x"])) if len(batch) else np.empty((0, 0))
            cell = np.clip((x - low) // width, 0, 2**bits - 1).astype(np.uint8)
            yield pd.DataFrame({"id": batch["id"], "cells": [c.tobytes() for c in cell], "x": list(x)})

    table = durable.cut(table.mapInPandas(approximate, "id long, cells binary, x array<double>"), "cells")

    def top(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        q, x, ids = matrix(queries["x"]), matrix(held["x"]), held["id"].to_numpy()
        out = []
        if not exact:
            wide = lambda m: np.array([[int(v) for v in r] for r in m], dtype=object)
            every = np.clip(wide(q) @ wide(x).T, -(2**63), 2**63 - 1)
        cells = np.frombuffer(b"".join(held["cells"]), np.uint8).reshape(len(held), -1)
        for start in range(0, len(q), 128):
            if exact:
                lower, upper = bounds(q[start:start + 128], cells, low, width)
            for i in range(start, min(start + 128, len(q))):
                own = ids == queries["id"].iat[i]
                if exact:
                    lower[i - start][own] = upper[i - start][own] = -np.inf
                    at, score = refine(q[i], x, ids, lower[i - start], upper[i - start], k)
                else:
                    at = sorted(np.flatnonzero(~own), key=lambda j: (-every[i, j], ids[j]))[:k]
                    score = every[i, at]
                out.append(pd.DataFrame({"query_id": queries["id"].iat[i], "vec_id": ids[at], "score": np.array(score).astype(np.int64)}))
        return pd.concat(out)

    every_part = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = table.filter(F.col("id") % query_every == 0).select("id", "x", share("id", query_parts).alias("qb"),
                                                                   every_part(row_parts).alias("rb"))
    held = table.select("id", "cells", "x", share("id", row_parts).alias("rb"), every_part(query_parts).alias("qb"))
    return search_blocks(held, queries, ["rb", "qb"], top, "long", k)
