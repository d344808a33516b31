"""Running a stream over everything available now and reading its result as a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.plans import durable


STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for queries that start inside; a started query keeps a copy, so they are put back at once."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """New files of a folder, each read exactly once per checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if "*" not in path:
        path = f"{path[:-1]}[{path[-1]}]"  # a pattern may match a single file, a plain path must be a folder
    return reader.load(path)


def event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on a zone-less timestamp column."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int) -> DataFrame:
    """The committed files of a folder that a stream writes, ``max_files`` at a trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def append_to(stream: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ()) -> StreamingQuery:
    """Process what is there and stop; a rerun with the same checkpoint goes on where it ended."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    query = (writer.partitionBy(*by) if by else writer).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_by_clock(stream: DataFrame, path: str, checkpoint: str, every: str) -> StreamingQuery:
    """A micro-batch every ``every``, until what is there is processed; then the query is stopped, and a rerun goes on from there."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def append_result(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    root = durable.scratch_dir(spark, label)
    append_to(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def each_batch(stream: DataFrame, label: str, write: Callable[[DataFrame, int, str], None],
               mode: str = "append") -> tuple[StreamingQuery, str]:
    """foreachBatch with a folder; ``write`` must give the same files when a batch is replayed."""
    root = durable.scratch_dir(stream.sparkSession, label)
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(lambda df, batch: write(df, batch, root)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query, root


def replace_each_batch(stream: DataFrame, root: str, make: Callable[[], DataFrame]) -> DataFrame:
    """After every micro-batch of ``stream`` the table is made anew as ``<root>/v=<batch>``, and a replayed batch writes over its own;
    returns the table after the last one."""
    def write(df: DataFrame, batch: int) -> None:
        make().write.mode("overwrite").parquet(f"{root}/v={batch}")

    query = stream.writeStream.option("checkpointLocation", f"{root}-checkpoint").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    versions = stream.sparkSession.read.option("basePath", root).parquet(f"{root}/v=*")
    return versions.filter(F.col("v") == versions.agg(F.max("v")).scalar()).drop("v")


def _write_batch(df: DataFrame, batch: int, root: str) -> None:
    df.withColumn("batch_id", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{root}/out/b={batch}")


def mode_result(stream: DataFrame, label: str, mode: str, keys: list[str]) -> DataFrame:
    """Final table of an ``update`` (last row per key) or ``complete`` (last batch) stream."""
    spark = stream.sparkSession
    _, root = each_batch(stream, label, _write_batch, mode)
    rows = spark.read.parquet(f"{root}/out/b=*")
    if mode == "complete":
        last = rows.agg(F.max("batch_id"))
        return rows.filter(F.col("batch_id") == last.scalar()).drop("batch_id")
    from lakeloom.plans import skew

    return skew.latest_per_key(rows, keys, [F.desc("batch_id")]).drop("batch_id")


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Rows, state size and late drops per micro-batch of a finished query."""
    rows = []
    for p in query.recentProgress:
        ops = p.stateOperators
        rows.append((p.batchId, p.numInputRows, sum(o.numRowsTotal for o in ops), sum(o.numRowsDroppedByWatermark for o in ops)))
    return spark.createDataFrame(rows, "batch_id long, input_rows long, state_rows long, late_rows long")
