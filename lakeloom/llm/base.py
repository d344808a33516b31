"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def slices(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts hold about ``chars`` characters; one longer text makes a range of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def small_batches(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of one take a few megabytes, however long single texts are."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.diff(np.frombuffer(batch.column(text).cast(pa.large_string()).buffers()[1], np.int64)[
            batch.column(text).cast(pa.large_string()).offset:][: batch.num_rows + 1])
        part = (np.cumsum(size) - size) // 4_000_000
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def byte_batches(batches: Iterable[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut where a binary column passes a further ``most`` bytes; one longer value makes a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


class Memo(dict):
    """A dictionary that computes what it lacks and starts anew when full, so that it stays small on any input."""

    def __init__(self, compute, most: int = 400_000):
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves, the others for the letters from U+0100 on.
    """
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in kept else chr(extra))
        extra += b not in kept
    return out


def splitter(pattern: str) -> regex.Pattern:
    """The pattern as the tokenizer libraries read it: ``\\s`` is the property White_Space."""
    return regex.compile(pattern, regex.V0)
