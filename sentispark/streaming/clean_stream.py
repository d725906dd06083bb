"""Structured Streaming form of the cleaner.

The study has no streams; its cleaning (T1-T9) is a stateless row
expression, so the same Column runs unchanged on ``readStream``.  New
documents landing in a folder are cleaned and appended to a parquet table;
the checkpoint folder makes the sink exactly-once across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentispark.functions import text as T
from sentispark.operators.corpus import keep_where

DOC_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def cleaned_stream(spark: SparkSession, src_dir: str, file_glob: str = "documents*.parquet",
                   schema: str = DOC_SCHEMA, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame ``(doc_id, text)`` of cleaned, non-empty texts.  ``file_glob`` names
    files of ``src_dir``, or folders whose files are read (a table Spark wrote is one)."""
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(f"{src_dir.rstrip('/')}/{file_glob}"))
    return raw.select("doc_id", keep_where(T.clean_text("text"), lambda t: ~T.is_empty_text(t)).alias("text"))


def run_to_table(stream: DataFrame, out_dir: str, checkpoint_dir: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append the stream to parquet; ``available_now`` drains what is there
    and stops (batch-like runs); otherwise it keeps running."""
    w = stream.writeStream.format("parquet").option("path", out_dir).option(
        "checkpointLocation", checkpoint_dir).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stream_clean_documents(spark: SparkSession, sf_dir: str, work_dir: str) -> DataFrame:
    """Drain the documents of ``sf_dir`` through the streaming cleaner into
    ``work_dir`` and return the written table."""
    q = run_to_table(cleaned_stream(spark, sf_dir), f"{work_dir}/out", f"{work_dir}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{work_dir}/out").select("doc_id", F.col("text"))
