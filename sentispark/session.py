"""Spark session helpers.

The engine never creates data on the driver: it only configures a session
and, where a job needs to cut lineage (iterative learners), makes sure a
checkpoint directory is set.  On a cluster that directory must come from the
session (``spark.checkpoint.dir``); a private temporary folder is only used
when nothing was configured (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "sentispark",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return (or create) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", conf.pop("driver_memory", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("_", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Ship this package to the executors' Python workers (``addPyFile``).

    Operators that run Python in tasks (``mapInPandas``, pandas UDFs) refer to
    module-level helpers; workers import them from the shipped zip, the same
    way ``--py-files`` would, whatever the driver's working directory."""
    import os
    import tempfile
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="sentispark-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home: ``spark.checkpoint.dir``, which
    a cluster names.  Where nothing is set (tests, laptops) a fresh temporary
    folder is taken, with a warning."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = tempfile.mkdtemp(prefix="sentispark-ckpt-")
        warnings.warn(f"spark.checkpoint.dir is not set; using {configured}, which only this machine sees", stacklevel=2)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss) into the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """A result that several branches read: written as a Parquet table in the shared
    checkpoint folder and read back (compressed, scans read only the columns asked for).
    The folder goes when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table made by :func:`write_once` that nothing still to run reads."""
    target = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
    target.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
