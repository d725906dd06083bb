"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.session import ensure_checkpoint_dir, ship_package


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder set, package shipped to the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the session's shared checkpoint folder; its
    content goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage: write ``df`` as a Parquet table in the shared folder
    and read it back.  Unlike ``checkpoint()`` the result is compressed and its
    scans read only the columns asked for."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written`, before the application ends.  Only for tables that
    nothing still to run reads: what was made from them has been written itself."""
    for table in tables:
        spark = table.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast of a (narrow) table that counts at most ``rows`` rows;
    beyond that Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unused_name(df: DataFrame, label: str) -> str:
    """A column name that ``df`` does not have."""
    return f"__{label}_{uuid.uuid4().hex}"
