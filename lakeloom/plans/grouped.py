"""Comparing all rows of a group inside tasks, with large groups cut into pairs of parts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_borders(keys: np.ndarray) -> np.ndarray:
    """Borders of the runs of equal values: the start of each, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def in_blocks(rows: DataFrame, key: str, member: str, size: str, most: int) -> DataFrame:
    """``rows`` with (part, a, b): a group of more than ``most`` rows is dealt over parts, and a row is repeated for each pair a < b of parts
    that has its own, so that any two rows of a group meet somewhere and no pair of parts holds more than about 2 * ``most``."""
    parts = F.ceil(F.col(size) / most).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), member), F.col("parts")).cast("int"))
    other = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: x != F.col("part")))
    rows = rows.withColumn("other", F.explode(other))
    rows = rows.withColumns({"a": F.least("part", "other"), "b": F.greatest("part", "other")})
    return rows.withColumn("group", F.xxhash64(key, "a", "b")).drop("parts", "other")


def by_group(work: Callable[[pa.Table], pa.RecordBatch | None]) -> Callable:
    """A function for ``mapInArrow`` over rows sorted by ``group``: ``work`` for each whole group, results in larger batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[pa.RecordBatch] = []

        def close() -> None:
            found = work(pa.Table.from_batches(held))
            if found is not None:
                out.append(found)
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("group").to_numpy()
            if held and held[0].column("group")[0].as_py() != keys[0]:
                close()
            borders = run_borders(keys)
            for i, (a, z) in enumerate(zip(borders, borders[1:])):
                if i:
                    close()
                held.append(batch.slice(a, z - a))
            if sum(b.num_rows for b in out) > 5000:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out.clear()
        if held:
            close()
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return run


def first_connected(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, parent) of each row by a matrix of links: the first row it is connected to, and the row it was reached from."""
    root, parent = np.full(len(linked), -1), np.arange(len(linked))
    for i in range(len(linked)):
        if root[i] < 0:
            root[i], front = i, np.array([i])
            while len(front):
                reached = np.flatnonzero(linked[front].any(0) & (root < 0))
                parent[reached] = front[linked[np.ix_(front, reached)].argmax(0)]
                root[reached] = i
                front = reached
    return root, parent


def overlaps(sets: list[np.ndarray], stretch: int = 4096) -> np.ndarray:
    """How many members each two sets share, from the members that at least two of them have, a stretch at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    borders = run_borders(every)
    number = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    shared = np.diff(borders) > 1
    keep, number = shared[number], (np.cumsum(shared) - 1)[number]
    owner, number = owner[keep], number[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(shared.sum()), stretch):
        a, z = np.searchsorted(number, [start, start + stretch])
        has = np.zeros((len(sets), stretch), np.float32)
        has[owner[a:z], number[a:z] - start] = 1
        out += has @ has.T
    return out.astype(np.int64)
