"""Tables kept as numbered Parquet snapshots (``v=0``, ``v=1``, ...) with a commit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "version bigint, operation string, rows bigint, committed_at timestamp_ntz"


class VersionedTable:
    """Each commit writes a whole snapshot first and its log record last."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _snapshot(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.path}/_log")

    def commit(self, df: DataFrame, version: int, operation: str, committed_at: Column) -> None:
        df.write.mode("overwrite").parquet(self._snapshot(version))
        rows = self.spark.read.parquet(self._snapshot(version)).agg(F.count("*").alias("rows"))
        rows.select(
            F.lit(version).cast("bigint").alias("version"), F.lit(operation).alias("operation"), "rows",
            committed_at.alias("committed_at"),
        ).write.mode("append").parquet(f"{self.path}/_log")

    def as_of_version(self, version: int) -> DataFrame:
        return self.spark.read.parquet(self._snapshot(version))

    def as_of_time(self, at: Column) -> DataFrame:
        last = self.log().filter(F.col("committed_at") <= at).agg(F.max("version")).first()[0]
        if last is None:
            raise ValueError("no version at that time")
        return self.as_of_version(last)

    def restore(self, version: int, as_version: int, committed_at: Column) -> None:
        self.commit(self.as_of_version(version), as_version, f"RESTORE {version}", committed_at)
