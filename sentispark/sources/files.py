"""File sources and sinks of the study.

All readers take explicit schemas (no inference); all writers go through
``DataFrameWriter`` so a job writes in parallel from its partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.functions import text as T

RAW_SCHEMA = ("sentiment INT, id BIGINT, date STRING, query_string STRING, user STRING, text STRING")
CLEAN_SCHEMA = "row_id BIGINT, text STRING, target INT"
FOLDERS = ("train/pos", "train/neg", "test/pos", "test/neg", "train/unsup")


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headerless Latin-1 CSV, doubled quotes inside quoted fields."""
    return (spark.read.schema(RAW_SCHEMA)
            .option("header", "false").option("encoding", "ISO-8859-1")
            .option("quote", '"').option("escape", '"')
            .option("multiLine", str(multi_line).lower()).csv(path))


def write_raw_csv(df: DataFrame, path: str) -> None:
    """The raw layout (six columns, no header, Latin-1, quotes doubled)."""
    (df.select(*[c.split()[0] for c in RAW_SCHEMA.split(", ")]).write.mode("overwrite")
     .option("header", "false").option("encoding", "ISO-8859-1").option("quote", '"')
     .option("escape", '"').csv(path))


def read_indexed_csv(spark: SparkSession, path: str, schema: str = CLEAN_SCHEMA,
                     multi_line: bool = False) -> DataFrame:
    """CSV with a header whose first column is the saved row index.
    ``multi_line`` reads quoted fields that contain line breaks."""
    return (spark.read.schema(schema).option("header", "true").option("encoding", "UTF-8")
            .option("multiLine", str(multi_line).lower()).option("escape", '"').csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """S3: write a table (parquet by default; ``fmt='csv'`` writes a header)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", "true").option("encoding", "UTF-8").option("escape", '"')
    w.format(fmt).save(path)


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Build only when the output does not exist yet."""
    df.write.mode("ignore").format(fmt).save(path)


def folder_split(folder: Column) -> Column:
    """Split of a ``<split>/<label>`` folder; unlabelled training texts are ``extra``."""
    split = F.regexp_extract(folder, r"^([^/]+)/", 1)
    return F.when((split == "train") & folder.endswith("/unsup"), "extra").otherwise(split)


def folder_sentiment(folder: Column) -> Column:
    return F.when(folder.endswith("/pos"), F.lit(1.0)).when(folder.endswith("/neg"), F.lit(0.0)).otherwise(F.lit(None).cast("double"))


def read_text_dir(spark: SparkSession, root: str, folders=FOLDERS) -> DataFrame:
    """One document per file under ``root/<split>/<label>/*.txt``.

    Split and label come from the file path, not from the listing order.
    Returns ``(path, folder, split, sentiment, text)``.
    """
    paths = [f"{root.rstrip('/')}/{f}/*.txt" for f in folders]
    df = spark.read.text(paths, wholetext=True)  # as an option it would be overridden
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, r"/([^/]+/[^/]+)/[^/]+$", 1)
    return df.select(path.alias("path"), folder.alias("folder"), folder_split(folder).alias("split"),
                     folder_sentiment(folder).alias("sentiment"), F.col("value").alias("text"))


def write_folder_text(docs: DataFrame, root: str, one_line: bool = False) -> None:
    """One normalised line per document, one output folder per source
    folder (``train-pos`` ...), written in parallel by partition.
    ``one_line`` turns line breaks inside a document into spaces."""
    text = F.translate("text", "\r\n", "  ") if one_line else F.col("text")
    out = docs.select(T.path_to_name("folder").alias("file"),
                      T.normalize_review(T.replace_control(text)).alias("value"))
    out.write.mode("overwrite").partitionBy("file").text(root)


def save_model(model, path: str) -> None:
    """Persist a fitted pyspark.ml model (or pipeline)."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    """Reload with the model's own class (e.g. ``PipelineModel``)."""
    return cls.load(path)


def save_matrix(spark: SparkSession, rows: list, path: str, schema: str = "id int, vec array<double>") -> None:
    """S9 for custom models: a weight matrix as a parquet table."""
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
