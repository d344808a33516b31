"""File readers and writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.plans import durable
from lakeloom.plans.skew import estimated_bytes, row_bytes

FILE_BYTES = 128 * 2**20
SORT_BYTES = 256 * 2**20


def with_file_metadata(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_modification_time").alias("file_time"))


def read_csv(spark: SparkSession, path: str, hints: Mapping[str, str] | None = None) -> DataFrame:
    """CSV with a header; types are inferred once and overridden by ``hints``."""
    inferred = spark.read.csv(path, header=True, inferSchema=True).schema
    hints = dict(hints or {})
    fields = [T.StructField(f.name, T.DataType.fromDDL(hints[f.name]) if f.name in hints else f.dataType) for f in inferred]
    return spark.read.schema(T.StructType(fields)).csv(path, header=True)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of the files below a folder; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


class LoadLog:
    """The files that a target table has taken in, by load.

    Load n puts its rows into ``<target>/load=n`` and then its files into ``<log>/load=n``; the log is what commits it. Rows of a load that
    failed in between are not part of the table, and the next load writes over them.
    """

    SCHEMA = "path string, length long, modified timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def loads(self) -> list[int]:
        """Numbers of the committed loads."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/load=*/_SUCCESS")
        found = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(hadoop)
        return sorted(int(f.getPath().getParent().getName().removeprefix("load=")) for f in found or [])

    def loaded(self) -> DataFrame:
        loads = self.loads()
        reader = self.spark.read.schema(self.SCHEMA)
        return reader.parquet(*[f"{self.path}/load={n}" for n in loads]) if loads else self.spark.createDataFrame([], self.SCHEMA)

    def add(self, load: int, files: DataFrame) -> None:
        files.write.mode("overwrite").parquet(f"{self.path}/load={load}")

    def table(self, target: str) -> DataFrame:
        """Rows of the committed loads; columns that only some of them have are NULL in the others."""
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{target}/load={n}" for n in self.loads()])


def load_new_files(spark: SparkSession, folder: str, read: Callable[[list[str]], DataFrame], target: str, log: LoadLog, pattern: str = "*") -> int:
    """Append the rows of files not loaded before; returns how many files that were.

    Old files are neither opened nor read: a listing without the logged paths says which are new, and only those go to ``read``. Their
    list, as long as what is new, passes through the driver. Files that arrive after the listing wait for the next load.
    """
    new = durable.cut(listing(spark, folder, pattern).join(log.loaded().select("path"), "path", "left_anti"), "new-files")
    return _load(read, new, target, log)


def copy_into(source: DataFrame, target: str, log: LoadLog) -> int:
    """As :func:`load_new_files` for a table of files that is open already, whose file names are taken from its rows; this reads old files too."""
    tagged = source.withColumn("path", F.col("_metadata.file_path"))
    new = tagged.select("path").distinct().join(log.loaded().select("path"), "path", "left_anti")
    new = durable.cut(new.select("path", F.lit(None).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified")), "new-files")
    return _load(lambda paths: tagged.join(new.select("path"), "path", "left_semi").drop("path"), new, target, log)


def _load(read: Callable[[list[str]], DataFrame], new: DataFrame, target: str, log: LoadLog) -> int:
    paths = [r.path for r in new.select("path").collect()]
    if paths:
        load = max(log.loads(), default=-1) + 1
        read(paths).write.mode("overwrite").parquet(f"{target}/load={load}")
        log.add(load, new)
    return len(paths)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """One directory per partition value; rows of a value meet in few tasks, more where they are many, so files are large and even."""
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode(mode).partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df``; a rerun gives the same table."""
    rows = df.hint("rebalance", *[F.col(c) for c in by])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_merged(spark: SparkSession, path: str, *frames: DataFrame) -> DataFrame:
    """Append frames whose columns differ; older rows read as NULL in the newer columns."""
    for f in frames:
        f.write.mode("append").parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def rescued(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """JSON text to columns; what the schema has no place for goes to ``_rescued_data``.

    Rows that miss the schema keep their whole text there, rows with fields beyond the schema keep those fields as JSON.
    """
    full = T.StructType([*schema.fields, T.StructField("_rescued_data", T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rescued_data"}
    every = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    beyond = F.map_filter(every, lambda k, v: ~k.isin(*schema.names))
    parsed = df.withColumns({"__j": F.from_json(text, full, opts), "__x": beyond})
    kept = F.coalesce(F.col("__j._rescued_data"), F.when(F.size("__x") > 0, F.to_json("__x")))
    return parsed.select(*[c for c in df.columns if c != text], *[F.col(f"__j.{n}").alias(n) for n in schema.names], kept.alias("_rescued_data"))


def cluster_by(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """Rewrite small files into sorted ranges, ``files`` of them or as many as the size asks for, so min/max statistics prune on the first key."""
    files = files or file_count(df)
    df.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def file_count(df: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Files of about ``file_bytes`` that hold ``df``, by the optimizer's estimate of its size.

    A file is sorted by one task, so there are more of them where the rows, counted, would fill more than ``SORT_BYTES`` of its memory.
    """
    return max(1, -(-estimated_bytes(df) // file_bytes), -(-row_bytes(df) // SORT_BYTES))
