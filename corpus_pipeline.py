"""A corpus made ready for training: from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read again as the next stage's docs. All stages but the last return
the columns of documents. None has a SQL form as a whole: the classifier, the tagger and the packing are not SQL; tests hold the parts
against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import line_runs, secret_tagger, shingle_forest, toxicity, vector_packing
from lakeloom.llm.base import table
from lakeloom.plans import durable


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one has."""
    kept = line_runs.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", line_runs.n_chars(docs)).select(*docs.columns)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return shingle_forest.without_similar(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_tagger.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    return vector_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("n-gram Jaccard join", drop_similar), ("secret scans", hide_secrets),
          ("best-fit packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable.cut(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
