"""A table clustered on several columns at once along a space-filling curve, read by the value ranges of its files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.plans import durable, ordered
from lakeloom.sources.files import FILE_BYTES, file_count

BITS = 8  # a column is ranked into 2**BITS pieces


def interleaved(ranks: Sequence[Column]) -> Column:
    """The bits of all ranks in turn, the highest bits of each first: rows close in every rank are close in this number."""
    bits = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long"), b * len(ranks) + i)
            for i, r in enumerate(ranks) for b in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


class ClusteredTable:
    """Rows in files that each hold a small range of every clustered column.

    Columns are ranked by borders that are taken from the first rows and kept, the ranks' bits are interleaved, and files are ranges of that
    number. What arrives is clustered on its own into a generation of files; older files stay as they are until ``compact``. Beside the
    files a table of their smallest and largest values says which ones a filter on any of the columns can need.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], file_bytes: int = FILE_BYTES):
        self.spark, self.path, self.columns, self.file_bytes = spark, path.rstrip("/"), list(columns), file_bytes
        self.live: list[int] = []
        self.made = 0

    def add(self, df: DataFrame) -> None:
        """Cluster new rows into a generation of their own; no earlier file is read."""
        if not self.made:
            ordered.even_borders(df, self.columns, 2**BITS).write.parquet(f"{self.path}/_borders")
        self.live.append(self._write(df))

    def compact(self) -> None:
        """Cluster all generations into one."""
        old, self.live = self.live, [self._write(self._rows(self.live))]
        for n in old:
            durable.discard(self.spark, f"{self.path}/g={n}")
            durable.discard(self.spark, f"{self.path}/_ranges/g={n}")

    def ranges(self) -> DataFrame:
        """(file, rows, then lo_ and hi_ of each column) of all files."""
        return self.spark.read.parquet(*[f"{self.path}/_ranges/g={n}" for n in self.live])

    def read(self, **bounds: tuple) -> tuple[DataFrame, int, int]:
        """(rows with low <= column <= high for every bound, files read, files in all); None leaves a side open."""
        files = self.ranges()
        wanted, keep = F.lit(True), F.lit(True)
        for c, (low, high) in bounds.items():
            if low is not None:
                wanted, keep = wanted & (F.col(c) >= F.lit(low)), keep & (F.col(f"hi_{c}") >= F.lit(low))
            if high is not None:
                wanted, keep = wanted & (F.col(c) <= F.lit(high)), keep & (F.col(f"lo_{c}") <= F.lit(high))
        picked = [r.file for r in files.filter(keep).select("file").collect()]
        every = self._rows(self.live)
        rows = self.spark.read.schema(every.schema).parquet(*picked) if picked else every.limit(0)
        return rows.filter(wanted), len(picked), files.count()

    def _rows(self, generations: list[int]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/g={n}" for n in generations])

    def _write(self, df: DataFrame) -> int:
        n, self.made = self.made, self.made + 1
        borders = self.spark.read.parquet(f"{self.path}/_borders")
        placed = df
        for c in self.columns:
            with_both = ordered.with_coarse(borders.select(F.col(c).alias("b")), "b", "c").select(F.struct("b", "c"))
            placed = placed.withColumns({"__v": F.struct(c), "__e": with_both.scalar()})
            placed = placed.withColumns({"__b": F.col("__e.b"), "__c": F.col("__e.c")})
            placed = ordered.numbered(placed, "__v", "__b", "__c", f"__rank_{c}").drop("__v", "__e", "__b", "__c")
        curve = interleaved([F.col(f"__rank_{c}") for c in self.columns])
        laid = placed.withColumn("__z", curve).repartitionByRange(file_count(df, self.file_bytes), "__z", *self.columns)
        laid.sortWithinPartitions("__z").select(*df.columns).write.parquet(f"{self.path}/g={n}")
        ends = [x for c in self.columns for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]
        files = self._rows([n]).select("*", F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("rows"), *ends)
        files.coalesce(1).write.parquet(f"{self.path}/_ranges/g={n}")
        return n
