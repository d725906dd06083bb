"""Operator 2: exact deduplication by Grace hashing on complete content.

Spark deals records out by a hash of the normalised text; inside a task a
bucket is read into an open-addressing table that compares complete content.
When the table is full, records that match nothing resident go to spill files
by the next hash bits and every file is treated the same way, one level deeper.
Resident content stays resident and goes on absorbing its copies, so every
level settles at least one distinct text and one huge group of copies never
needs more memory than one text.

Copies are absorbed twice: in the scan's own tasks before anything is moved
(so a text held by a third of all rows reaches the exchange once a task), then
after the exchange.  The spill files are anonymous temporary files of the
running task, like Spark's own spills; a lost task starts over.

Defined results: null text counts as empty and equals other empty texts; of
equal texts the smallest ``doc_id`` stays (a null id sorts last); an empty table gives no
rows; extra columns are not read by :func:`text_classes`.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentispark.llm.common import unused_name

#: White space replaced by one space before texts are compared.
WHITE = r"[\x20\x09-\x0D]+"
CLASSES = "h long, content string, min_id long, n long, n_min long"
_SCHEMA = pa.schema([("h", pa.int64()), ("content", pa.string()), ("min_id", pa.int64()),
                     ("n", pa.int64()), ("n_min", pa.int64())])
_BATCH_BYTES = 4 << 20


class OpenTable:
    """Open addressing with linear probing over ``slots`` (a power of two)
    places; entries compare hash, then complete content."""

    def __init__(self, max_bytes: int, slots: int):
        self.mask, self.limit, self.max_bytes, self.bytes = slots - 1, slots * 7 // 10, max_bytes, 0
        self.place = [-1] * slots
        self.hash: list[int] = []
        self.content: list[str] = []
        self.stats: list[list] = []

    def absorb(self, h: int, content: str, min_id: int | None, n: int, n_min: int) -> bool:
        """Merge the record into its entry, or make one; False when it has none
        and the table is full."""
        at = h & self.mask
        while (entry := self.place[at]) >= 0:
            if self.hash[entry] == h and self.content[entry] == content:
                s = self.stats[entry]
                s[1] += n
                if min_id is not None and (s[0] is None or min_id < s[0]):
                    s[0], s[2] = min_id, n_min
                elif min_id == s[0]:
                    s[2] += n_min
                return True
            at = (at + 1) & self.mask
        if self.hash and (len(self.hash) >= self.limit or self.bytes + len(content) > self.max_bytes):
            return False
        self.place[at] = len(self.hash)
        self.hash.append(h)
        self.content.append(content)
        self.stats.append([min_id, n, n_min])
        self.bytes += len(content)
        return True


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + len(r[1])
        if size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


class _Spill:
    """One spill file: Arrow batches in an anonymous temporary file."""

    def __init__(self):
        self.file, self.held, self.size = tempfile.TemporaryFile(), [], 0
        self.writer = pa.ipc.new_stream(self.file, _SCHEMA)

    def add(self, row: tuple) -> None:
        self.held.append(row)
        self.size += 64 + len(row[1])
        if self.size >= 1 << 20:
            self.flush()

    def flush(self) -> None:
        for b in _batches(self.held, _SCHEMA):
            self.writer.write_batch(b)
        self.held, self.size = [], 0

    def rows(self) -> Iterator[tuple]:
        self.flush()
        self.writer.close()
        self.file.seek(0)
        for b in pa.ipc.open_stream(self.file):
            yield from zip(*(c.to_pylist() for c in b.columns))
        self.file.close()


def grace(rows: Iterable[tuple], max_bytes: int, slots: int, fan_out: int = 16, level: int = 0) -> Iterator[tuple]:
    """One ``(h, content, min_id, n, n_min)`` for each distinct content of ``rows``."""
    table, files = OpenTable(max_bytes, slots), {}
    for row in rows:
        if not table.absorb(*row):
            # a new seed on every level: what met in one file parts in the next
            part = xxhash.xxh64_intdigest(row[0].to_bytes(8, "little", signed=True), seed=level) % fan_out
            if part not in files:
                files[part] = _Spill()
            files[part].add(row)
    for h, c, s in zip(table.hash, table.content, table.stats):
        yield (h, c, *s)
    del table
    for part in sorted(files):
        yield from grace(files.pop(part).rows(), max_bytes, slots, fan_out, level + 1)


def _task(max_bytes: int, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        yield from _batches(grace(rows, max_bytes, slots), _SCHEMA)
    return run


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")


def text_classes(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 max_bytes: int = 64 << 20, slots: int = 1 << 17) -> DataFrame:
    """One row per distinct normalised text: ``content, keep_id, group_size,
    keep_copies`` (rows that carry ``keep_id`` itself, usually 1).

    ``max_bytes`` (characters) and ``slots`` bound one table, and so a task's memory."""
    content = docs.select(normalised(text).alias("content"), F.col(key).cast("long").alias("min_id"))
    records = content.select(F.xxhash64("content").alias("h"), "content", "min_id",
                             F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("n_min"))
    local = records.mapInArrow(_task(max_bytes, slots), CLASSES)
    merged = local.repartition("h").mapInArrow(_task(max_bytes, slots), CLASSES)
    return merged.select("content", F.col("min_id").alias("keep_id"), F.col("n").alias("group_size"),
                         F.col("n_min").alias("keep_copies"))


def dedup_documents(docs: DataFrame, **bounds: int) -> DataFrame:
    """Every row of ``docs`` with its class: ``doc_id, keep_id, group_size, kept,
    text_sha256`` (of the normalised text)."""
    sha = F.sha2(F.encode("content", "UTF-8"), 256)
    classes = text_classes(docs, **bounds).select(sha.alias("text_sha256"), "keep_id", "group_size")
    rows = (docs.select("doc_id", normalised().alias("content"))
            .select("doc_id", sha.alias("text_sha256")))
    return (rows.join(classes, "text_sha256")
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; rows that repeat both the
    text and the id of a row that stays are one row afterwards (the window sees
    the join's own partitioning, so it moves nothing again)."""
    def ident(sha: Column, doc_id: Column) -> Column:
        return F.concat_ws(":", sha, F.coalesce(doc_id.cast("string"), F.lit("null")))

    name, place = unused_name(docs, "ident"), unused_name(docs, "first")
    kept = text_classes(docs).select(ident(F.sha2(F.encode("content", "UTF-8"), 256), F.col("keep_id")).alias(name))
    keyed = docs.withColumn(name, ident(F.sha2(F.encode(normalised(), "UTF-8"), 256), F.col("doc_id")))
    first = F.row_number().over(Window.partitionBy(name).orderBy(F.lit(0)))
    return (keyed.join(kept, name, "left_semi").withColumn(place, first)
            .where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns]))
