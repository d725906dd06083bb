"""One document a file, ``root/<folder>/<key>.<attempt>.txt``, as a Spark data source.

Spark's text writer puts many rows into a file.  The ``document_files`` format writes one file a
row, from the executors.  Its commit protocol needs no renames: file names carry the task
attempt, a finished task lists its files in ``commits/``, and the driver's commit names the
lists of the attempts that count in ``commits/<job>.done`` (a line a task).  Readers take
the files that committed lists name; what lost or repeated attempts left behind is not read.

``root`` is a folder that all executors see (a shared mount, or any store that ``pyarrow.fs``
opens: ``hdfs://``, ``s3a://``, ``gs://``).  Defined results: a null text is an empty file; a null
folder is ``root`` itself; rows with equal folder and key are files of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

COMMITTED = "commits"  # no leading underscore: Spark's readers skip such names


def _store(root: str) -> tuple[pafs.FileSystem, str]:
    if root.startswith(("s3a://", "s3n://")):
        root = "s3://" + root.split("://", 1)[1]
    if root.startswith("file:/"):
        root = "/" + root[5:].lstrip("/")
    fs, path = pafs.FileSystem.from_uri(root)
    return fs, path.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    listing: str
    files: int


class DocumentFileWriter(DataSourceWriter):
    def __init__(self, root: str, job: str):
        self.root, self.job = root, job

    def write(self, iterator: Iterator[Row]) -> Written:
        fs, root = _store(self.root)
        attempt, made, names = uuid.uuid4().hex, set(), []
        for n, row in enumerate(iterator):
            folder = "/".join(quote(p) for p in (row["folder"] or "").split("/") if p not in ("", ".", ".."))
            if folder not in made:
                fs.create_dir(f"{root}/{folder}", recursive=True)
                made.add(folder)
            name = f"{folder}/{quote(str(row['key']), safe='')}.{attempt}-{n}.txt".lstrip("/")
            with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write((row["text"] or "").encode())
            names.append(name)
        fs.create_dir(f"{root}/{COMMITTED}", recursive=True)
        listing = f"{attempt}.list"
        with fs.open_output_stream(f"{root}/{COMMITTED}/{listing}", compression=None) as f:
            f.write("".join(f"{x}\n" for x in names).encode())
        return Written(listing, len(names))

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _store(self.root)
        fs.create_dir(f"{root}/{COMMITTED}", recursive=True)
        with fs.open_output_stream(f"{root}/{COMMITTED}/{self.job}.done", compression=None) as f:
            f.write("".join(f"{m.listing}\n" for m in messages if m).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing to undo: no committed list names the files."""


class DocumentFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "document_files"

    def writer(self, schema: StructType, overwrite: bool) -> DocumentFileWriter:
        if overwrite:
            raise ValueError("document_files appends; take a new folder")
        return DocumentFileWriter(self.options["path"], uuid.uuid4().hex)


def write_document_files(docs: DataFrame, root: str) -> None:
    """``folder, key, text`` of every row as a file of its own; may be called again to append."""
    docs.sparkSession.dataSource.register(DocumentFiles)
    docs.select(F.col("folder").cast("string").alias("folder"), F.col("key").cast("string").alias("key"),
                F.col("text").cast("string").alias("text")).write.format("document_files").mode("append").option("path", root).save()


def committed_files(spark: SparkSession, root: str) -> DataFrame:
    """``name`` (relative to ``root``) of every file that a committed task wrote."""
    lists = f"{root.rstrip('/')}/{COMMITTED}/*"
    counted = spark.read.option("pathGlobFilter", "*.done").text(lists).select(F.col("value").alias("listing"))
    named = spark.read.option("pathGlobFilter", "*.list").text(lists).select(
        F.col("value").alias("name"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("listing"))
    return named.join(counted, "listing", "left_semi").select("name")


def read_document_files(spark: SparkSession, root: str) -> DataFrame:
    """``folder, key, text`` of the committed files below ``root``."""
    name = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), r"([^/]+)$", 1)
    texts = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
             .schema("value string").text(root, wholetext=True).select(name.alias("file"), "value"))
    wanted = committed_files(spark, root).select(
        F.regexp_extract("name", r"^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract("name", r"([^/]+)$", 1).alias("file"))
    key = F.regexp_extract("file", r"^(.*)\.[0-9a-f]{32}-[0-9]+\.txt$", 1)
    return wanted.join(texts, "file", "left").select(
        F.url_decode("folder").alias("folder"), F.url_decode(key).alias("key"), F.coalesce("value", F.lit("")).alias("text"))
