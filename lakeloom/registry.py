"""Registry that ties a named query to its Spark job and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The supplied Parquet tables of one directory, read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def spread(self, name: str, key: str) -> DataFrame:
        """The table over all cores even if the scan has fewer parts than that."""
        df = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)

    def views(self, *names: str) -> None:
        """Expose tables to ``spark.sql`` under their own names."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)


@dataclass(frozen=True)
class Entry:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with an optional oracle."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(name, fn, sql.strip() if sql else None)
        return fn

    return register


def presentable(df: DataFrame) -> DataFrame:
    """Dates, timestamps, decimals and string lists in a form every client prints alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)
