"""Line deduplication against levelled, sorted runs of line hashes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.base import text_or_empty
from lakeloom.plans import durable

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = 2**63 - 1


def n_chars(docs: DataFrame) -> Column:
    """The length of ``text`` in the type that ``docs`` has for it."""
    return F.length("text").cast(docs.schema["n_chars"].dataType)


class LineRuns:
    """Which document has each line first, as sorted runs (h1, h2, owner) on levels.

    A new batch is merge-joined against all runs and adds the lines that no run has as a run of level 0. When a level holds
    ``fanout`` runs they are merged into one of the next level, so n batches leave about fanout * log(n) runs. A line's hash is two
    64-bit hashes with different seeds. Batches must come in the order of their document numbers.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]

    def table(self) -> DataFrame | None:
        paths = [p for level in self.levels for p in level]
        return self._read(paths) if paths else None

    def add(self, lines: DataFrame) -> None:
        """``lines``: h1, h2, owner of one batch, repeated lines included."""
        fresh = lines.groupBy("h1", "h2").agg(F.min("owner").alias("owner"))
        known = self.table()
        if known is not None:
            fresh = fresh.join(known.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._write(fresh, 0)
        for n in range(len(self.levels)):
            if len(self.levels[n]) >= self.fanout:
                old, self.levels[n] = self.levels[n], []
                self._write(self._read(old).repartition("h1", "h2"), n + 1)
                for path in old:
                    durable.discard(self.spark, path)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, owner long").parquet(*paths)

    def _write(self, df: DataFrame, level: int) -> None:
        path = durable.scratch_dir(self.spark, f"run{level}")
        df.sortWithinPartitions("h1", "h2").write.parquet(path)
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(path)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 3) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text``, plus n_lines (before) and n_dropped.

    A line's key is the line without blanks (space, \\t, \\n, \\v, \\f, \\r) at its ends and with A-Z lower-cased. Keys of at least
    ``min_chars`` code points lose all their lines except in the smallest doc_id that holds them, which keeps even its own
    repetitions. The rest is joined by \\n; a text can become empty, no row is dropped. The table is taken in ``batches`` ranges of doc_id.

    Null and empty texts are one empty line. Rows with a null doc_id count as one document after all others. Rows that share a doc_id are
    parts of one document; equal rows give equal results. An empty table gives an empty result. Other columns are kept.
    """
    spark = docs.sparkSession
    docs = docs.withColumns({"text": text_or_empty(), "__did": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))})
    docs = docs.withColumn("__th", F.xxhash64("text"))
    exploded = docs.select("__did", "__th", F.posexplode_outer(F.split("text", "\n", -1)).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(BLANKS)), UPPER, LOWER)
    keys = exploded.select("__did", "__th", "pos", key.alias("key")).filter(F.length("key") >= min_chars)
    lines = durable.cut(keys.select("__did", "__th", "pos", F.xxhash64("key").alias("h1"),
                                    F.xxhash64(F.lit("second"), "key").alias("h2")), "lines")
    borders = lines.agg(F.percentile_approx("__did", [i / batches for i in range(1, batches)])).first()[0] if batches > 1 else []
    borders = sorted(set(borders or []))
    runs = LineRuns(spark, fanout)
    for low, high in zip([None, *borders], [*borders, None]):
        part = lines if low is None else lines.filter(F.col("__did") > low)
        part = part if high is None else part.filter(F.col("__did") <= high)
        runs.add(part.select("h1", "h2", F.col("__did").alias("owner")))
    gone = lines.join(runs.table(), ["h1", "h2"]).filter("owner < __did")
    gone = gone.groupBy("__did", "__th").agg(F.collect_set("pos").alias("__gone"))
    rows = docs.withColumn("__lines", F.split("text", "\n", -1)).drop("text").join(gone, ["__did", "__th"], "left")
    count = F.size("__lines")
    left = F.when(F.col("__gone").isNull(), F.col("__lines")).otherwise(
        F.transform(F.array_except(F.sequence(F.lit(0), count - 1), "__gone"), lambda i: F.col("__lines")[i]))
    return rows.withColumns({
        "text": F.array_join(left, "\n"), "n_lines": count.cast("long"),
        "n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")}).drop("__did", "__th", "__lines", "__gone")
