"""Corpus pipeline: ``documents`` through five operators of the llm subpackage.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next one's docs.
All stages but the last return the columns of their input, whatever they are.

Defined results: null texts pass as empty ones; a null doc_id is kept by every filter that
works by id; an empty table passes through to no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.llm import decontaminate, grace, jaccard, packing, toxicity
from sentispark.llm.common import broadcast_if_small, prepare, read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents scored 0.5 or more go."""
    return toxicity.reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of equal texts the row with the smallest doc_id stays."""
    prepare(spark)
    return grace.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of linked documents the smallest doc_id stays."""
    prepare(spark)
    groups = jaccard.jaccard_components(docs)
    gone = written(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    gone = broadcast_if_small(gone, jaccard.BROADCAST_IDS)
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: pieces of full sequences."""
    prepare(spark)
    return packing.piece_digests(packing.pack_documents(docs))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard", drop_near_copies),
          ("decontamination", drop_leaked), ("packing", pack)]

#: Learned scores and token ids have no SQL form; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
