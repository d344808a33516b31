"""A table laid out in ranges of its key, so that a merge reads and writes only the ranges its source reaches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.plans import durable, ordered

_B, _SUB = "__bucket", "__sub"


@dataclass
class MergeReport:
    """What a merge touched: buckets before it, those read, those written, and whether it was applied at all."""

    buckets: int
    read: int
    written: int
    applied: bool = True


class KeyedTable:
    """Rows unique in ``keys``, in folders that each hold one range of the key.

    ``_manifest/v=n`` names the folders of version n with their smallest key and row count. A merge writes new folders for the ranges
    it reaches and then the next manifest; until that is complete readers see the version before, and a repeated merge starts
    from it. Folders outside the source's keys are neither read nor written. Ranges beyond ``2 * rows_per_bucket`` are split. The manifest
    has a line per range and is read by the driver. Keys must not be NULL.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], rows_per_bucket: int = 1_000_000):
        self.spark, self.path, self.keys, self.rows_per_bucket = spark, path.rstrip("/"), list(keys), rows_per_bucket

    def version(self) -> int:
        """The last version whose manifest is complete; -1 if there is none."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest/v=*/_SUCCESS")
        found = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(hadoop)
        return max((int(f.getPath().getParent().getName().removeprefix("v=")) for f in found or []), default=-1)

    def manifest(self, version: int | None = None) -> DataFrame:
        """(low, folder, rows, batch) of each range."""
        return self.spark.read.parquet(f"{self.path}/_manifest/v={self.version() if version is None else version}")

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        folders = [r.folder for r in self.manifest(version).select("folder").collect()]
        return self._rows(folders) if folders else self.read(version - 1).limit(0)

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The rows whose key, or its first columns, ``keys`` has; only folders that can hold one are read."""
        lead = self.keys[: len(keys.columns)]
        lines = self.manifest().orderBy("low").collect()
        lows = self.manifest().agg(F.sort_array(F.collect_list(F.struct(*[F.col(f"low.{c}").alias(c) for c in lead]))).alias("lows"))
        wanted = keys.select(F.struct(*lead).alias("k"), lows.scalar().alias("lows")).distinct()
        # a key's rows may begin in the last range whose lower end is below it and go on while lower ends equal it
        first = F.greatest(F.size(F.filter("lows", lambda x: x < F.col("k"))) - 1, F.lit(0))
        upto = F.greatest(F.size(F.filter("lows", lambda x: x <= F.col("k"))) - 1, F.lit(0))
        reached = wanted.select(F.explode(F.sequence(first, upto)).alias("b")).distinct().collect()
        return self._rows([lines[r.b].folder for r in reached] or [lines[0].folder]).join(keys.select(*lead), lead, "left_semi")

    def _rows(self, folders: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(folders[0]).schema
        return self.spark.read.schema(schema).parquet(*folders)

    def create(self, df: DataFrame, batch: int = -1) -> None:
        """Lay ``df`` out in even ranges of the key."""
        parts = max(1, -(-df.count() // self.rows_per_bucket))
        laid = df.repartitionByRange(parts, *self.keys).withColumn(_B, F.spark_partition_id()).withColumn(_SUB, F.lit(0))
        self._commit(self._write(laid, 0), 0, batch)

    def merge(self, source: DataFrame, newest: Sequence[Column] = (), delete: Column | None = None, batch: int | None = None) -> MergeReport:
        """Rows of ``source`` replace rows of the same key, others are added; those for which ``delete`` holds are taken out.

        ``newest`` orders rows of one key, the first one wins (the source's on a tie); without it the source's row wins, which must
        then be unique per key. A ``batch`` number that the table has seen changes nothing, so a replayed micro-batch is harmless.
        """
        now = self.version()
        lines = self.manifest(now).orderBy("low").collect()
        if batch is not None and lines and lines[0].batch >= batch:
            return MergeReport(len(lines), 0, 0, applied=False)
        gone = F.coalesce(delete, F.lit(False)) if delete is not None else F.lit(False)
        routed = durable.cut(self._routed(source.withColumn("__gone", gone)), "merge-source")
        touched = sorted(r[_B] for r in routed.select(_B).distinct().collect())
        if not touched:
            self._commit(self.manifest(now), now + 1, batch)
            return MergeReport(len(lines), 0, 0)
        folders = [lines[b].folder for b in touched]
        target = self._routed(self._rows(folders))
        columns = [c for c in target.columns if c != _B]
        target = target.withColumns({"__gone": F.lit(False), "__mine": F.lit(0)})
        both = target.unionByName(routed.withColumn("__mine", F.lit(1)), allowMissingColumns=True).select(*target.columns).repartition(_B)
        rank = F.row_number().over(Window.partitionBy(_B, *self.keys).orderBy(*newest, F.desc("__mine")))
        merged = both.withColumn("__rank", rank).filter("__rank = 1 AND NOT __gone").drop("__rank", "__gone", "__mine")
        inside = Window.partitionBy(_B)
        place, held = F.row_number().over(inside.orderBy(*self.keys)), F.count("*").over(inside)
        sub = F.when(held > 2 * self.rows_per_bucket, F.floor((place - 1) / self.rows_per_bucket)).otherwise(0).cast("int")
        fresh = self._write(merged.withColumn(_SUB, sub).select(*columns, _B, _SUB), now + 1)
        # the first part of a range keeps its lower end, so that the ranges stay next to each other
        known = self.spark.createDataFrame([(b, lines[b].low) for b in touched], T.StructType([
            T.StructField(_B, T.IntegerType()), T.StructField("__low", self.manifest(now).schema["low"].dataType)]))
        fresh = durable.cut(fresh.join(F.broadcast(known), _B), "ranges")
        fresh = fresh.withColumn("low", F.when(F.col(_SUB) == 0, F.col("__low")).otherwise(F.col("low")))
        left = self.manifest(now).filter(~F.col("folder").isin(folders))
        self._commit(left.select("low", "folder", "rows").unionByName(fresh.select("low", "folder", "rows")), now + 1, batch)
        return MergeReport(len(lines), len(touched), fresh.count())

    def _routed(self, source: DataFrame) -> DataFrame:
        """``source`` with the number of the range its key falls in; keys below the first range belong to it."""
        ends = self.manifest().agg(F.sort_array(F.collect_list("low")).alias("lows"))
        inner = ordered.with_coarse(ends.select(F.slice("lows", 2, F.size("lows")).alias("lows")), "lows", "coarse")
        held = source.withColumns({"__key": F.struct(*self.keys), "__ends": inner.select(F.struct("lows", "coarse")).scalar()})
        held = held.withColumns({"__lows": F.col("__ends.lows"), "__coarse": F.col("__ends.coarse")})
        return ordered.numbered(held, "__key", "__lows", "__coarse", _B).drop("__key", "__ends", "__lows", "__coarse")

    def _write(self, laid: DataFrame, version: int) -> DataFrame:
        """The lines of a version's new folders, after writing them; a run that failed before its manifest is overwritten."""
        path = f"{self.path}/data/v{version}"
        laid.write.mode("overwrite").partitionBy(_B, _SUB).parquet(path)
        rows = self.spark.read.schema(laid.schema).parquet(path)
        return rows.groupBy(_B, _SUB).agg(F.min(F.struct(*self.keys)).alias("low"), F.count("*").alias("rows")).withColumn(
            "folder", F.concat(F.lit(f"{path}/{_B}="), F.col(_B), F.lit(f"/{_SUB}="), F.col(_SUB)))

    def _commit(self, lines: DataFrame, version: int, batch: int | None) -> None:
        last = F.lit(batch if batch is not None else -1).cast("long")
        lines.select("low", "folder", "rows", last.alias("batch")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_manifest/v={version}")

