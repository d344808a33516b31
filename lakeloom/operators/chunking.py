"""Documents to chunks. A document is one row, so the work on one is bounded by its own length."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.text import tokens

SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def _numbered(df: DataFrame, keys: Sequence[str], pieces: Column) -> DataFrame:
    """One row per piece.

    The outer form is used because the plain one also plants a size test below the projections, which
    would cut every text a second time.
    """
    with_pieces = df.withColumn("__pieces", pieces)
    rows = with_pieces.select(
        *keys, F.size("__pieces").alias("total_chunks"), F.posexplode_outer("__pieces").alias("chunk_index", "content"))
    return rows.filter(F.col("chunk_index").isNotNull())


def fixed_chunks(df: DataFrame, keys: Sequence[str], text: str, size: int = 1000, overlap: int = 200) -> DataFrame:
    """Windows of ``size`` characters that share ``overlap`` characters with the one before."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / F.lit(float(step))).cast("int"))
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(F.col(text), i * step + 1, F.lit(size)))
    return _numbered(df.filter(F.length(text) > 0), keys, pieces)


def token_chunks(df: DataFrame, keys: Sequence[str], text: str, size: int = 256, overlap: int = 30) -> DataFrame:
    step = size - overlap
    words = df.withColumn("__t", tokens(F.col(text)))
    last = F.greatest(F.lit(0), F.ceil((F.size("__t") - size) / F.lit(float(step))).cast("int"))
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(F.col("__t"), i * step + 1, size), " "))
    return _numbered(words, keys, F.when(F.size("__t") > 0, pieces))


def split_recursive(text: str, size: int, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Pieces of at most ``size`` characters cut at the coarsest separator that works; joined they give the text."""
    if len(text) <= size:
        return [text] if text else []
    sep, finer = separators[0], separators[1:]
    if sep == "":
        return [text[i : i + size] for i in range(0, len(text), size)]
    raw = text.split(sep)
    parts = [p + sep for p in raw[:-1]] + ([raw[-1]] if raw[-1] else [])
    out, current = [], ""
    for part in parts:
        if len(current) + len(part) <= size:
            current += part
            continue
        if current:
            out.append(current)
        current = ""
        if len(part) <= size:
            current = part
        else:
            out.extend(split_recursive(part, size, finer))
    return out + ([current] if current else [])


def recursive_chunks(df: DataFrame, key: str, text: str, size: int = 1000) -> DataFrame:
    """Recursive splitting, batch by batch in Python since each cut depends on the one before."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, c) for k, doc in zip(b["key"], b["text"]) for i, c in enumerate(split_recursive(doc, size))]
            yield pd.DataFrame(rows, columns=["key", "chunk_index", "content"])

    src = df.filter(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return src.mapInPandas(run, "key long, chunk_index int, content string").withColumnRenamed("key", key)


def header_chunks(df: DataFrame, key: str, text: str) -> DataFrame:
    """Sections between ``#`` / ``##`` / ``###`` lines, with the headers above as metadata."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    level = F.length(F.regexp_extract("line", r"^(#{1,3}) ", 1))
    title = F.regexp_replace("line", r"^#{1,3} ", "")
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)  # lines of one row
    tagged = lines.withColumns({"level": level, "title": title}).withColumn(
        "section", F.sum(F.when(F.col("level") > 0, 1).otherwise(0)).over(w))
    heads = tagged.filter("level > 0").select(key, "section", "level", "title")
    body = tagged.filter("level = 0").groupBy(key, "section").agg(
        F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    body = body.select(key, "section", F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("content"))
    named = heads
    for lv in (1, 2, 3):
        named = named.withColumn(f"__t{lv}", F.when(F.col("level") == lv, F.struct("section", "title")))
    s = Window.partitionBy(key).orderBy("section").rowsBetween(Window.unboundedPreceding, 0)
    for lv in (1, 2, 3):
        named = named.withColumn(f"__l{lv}", F.last(f"__t{lv}", ignorenulls=True).over(s))
    # a header counts only if no coarser header came after it
    named = named.select(
        key, "section", F.col("__l1.title").alias("h1"),
        F.when(F.col("__l2.section") > F.coalesce("__l1.section", F.lit(0)), F.col("__l2.title")).alias("h2"),
        F.when(F.col("__l3.section") > F.greatest(F.coalesce("__l1.section", F.lit(0)), F.coalesce("__l2.section", F.lit(0))), F.col("__l3.title")).alias("h3"))
    return body.join(named, [key, "section"], "left").filter(F.trim("content") != "")
