"""Readers for the parquet tables and the bound sentiment corpus.

The corpus stands in for the labelled short-message table: ``documents``
joined with ``labels`` on ``doc_id``; the raw label is ``4 * quality`` (the
0/4 encoding of the original data), normalised to 0/1 by
:func:`sentispark.operators.filters.normalize_label`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose text column feeds the cleaning expressions.  Its tasks are the
    scan's splits (``spark.sql.files.maxPartitionBytes``)."""
    return table(spark, sf_dir, name)


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, text, target)`` with ``target`` in {0, 4}.

    The join is left to Catalyst: ``labels`` is broadcast only when its
    parquet size is under ``spark.sql.autoBroadcastJoinThreshold``; beyond
    that it is a shuffle join on ``doc_id`` (AQE handles skew).
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (docs.join(labels, "doc_id")
            .select(F.col("doc_id").alias("row_id"), "text",
                    (F.col("quality") * 4).cast("int").alias("target")))


def all_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, text, target)`` of every document, labelled or not (``target`` null):
    the binding of queries that read no label."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), "text", F.lit(None).cast("int").alias("target"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


# SQL text of the same binding, for DuckDB oracle queries.
RAW_CORPUS_SQL = (
    "SELECT d.doc_id AS row_id, d.text AS text, CAST(4 * l.quality AS INTEGER) AS target "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
ALL_CORPUS_SQL = "SELECT doc_id AS row_id, text, CAST(NULL AS INTEGER) AS target FROM documents"
