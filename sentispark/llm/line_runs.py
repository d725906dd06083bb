"""Operator 11: line deduplication against levelled sorted runs of line hashes.

A line's key (white space stripped at both ends, A-Z lower-cased) is hashed to 128 bits.
Documents come in batches.  A batch's hashes, with the number of documents that hold each,

1. are merge-anti-joined with the *settled* run: hashes already known in ``threshold``
   documents need no further counting, which rids every later batch of the commonest lines,
2. become a sorted run of their own on level 0.

Every ``fan_out`` runs of a level are compacted into one run of the next level, counts added;
hashes that reach the threshold move to the settled run.  A run is a table bucketed and sorted
by hash, all runs with the same buckets, so only a batch itself is ever exchanged: joins with
runs read them bucket by bucket.

A second scan drops the lines.  The commonest settled hashes, at most ``hot_keys`` of them,
travel to the tasks as one block of 16 bytes each; all others meet the documents' distinct
hashes in a join by hash (copies of a text ask once), so no line is left out at any size and no
single hash of that join is among the commonest.

Defined results: null or empty text is one empty line; an empty key never goes; every row
counts as a document of its own, repeated and null ids too; a line found many times in one
document counts once; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.llm.common import prepare, shared_folder, written

#: Stripped at both ends of a line: [\x20\x09-\x0D].
WHITE = b" \t\n\x0b\x0c\r"
#: Hashes that a task combines before it hands them on.
COMBINE = 1 << 18
COUNTS = "batch int, h binary, n long"
_COUNTS = pa.schema([("batch", pa.int32()), ("h", pa.binary()), ("n", pa.int64())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])


def line_hashes(text: bytes) -> list[bytes | None]:
    """One hash per line, None where the key is empty."""
    # bytes.lower() changes A-Z alone
    keys = (line.strip(WHITE).lower() for line in text.split(b"\n"))
    return [xxhash.xxh3_128_digest(k) if k else None for k in keys]


def _count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, int] = {}

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.binary()),
             pa.array(list(held.values()), pa.int64())], schema=_COUNTS)

    for b in batches:
        for batch, text in zip(b.column(0).to_pylist(), b.column(1)):
            for h in set(line_hashes(text.as_py())) - {None}:
                held[batch, h] = held.get((batch, h), 0) + 1
            if len(held) >= COMBINE:
                yield block()
                held.clear()
    if held:
        yield block()


def line_counts(docs: DataFrame, batches: int, text: str = "text") -> DataFrame:
    """``batch, h, n``: documents that hold the hash, combined within tasks.  Rows are
    dealt to batches by a hash of their text."""
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    dealt = F.pmod(F.xxhash64(content), F.lit(batches)).cast("int")
    return docs.select(dealt.alias("batch"), content.alias("text")).mapInArrow(_count_lines, COUNTS)


class LineRuns:
    """Levelled runs of ``h binary, n long``; :meth:`add` takes any batch of such counts."""

    def __init__(self, spark: SparkSession, threshold: int, fan_out: int = 3, buckets: int | None = None):
        self.spark, self.threshold, self.fan_out = prepare(spark), threshold, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.settled: str | None = None
        self.tables: list[str] = []

    def store(self, df: DataFrame, label: str, *parts: str) -> str:
        """Write ``df`` as a table bucketed and sorted by ``h`` in the shared folder.  What
        comes from such tables lies in the same buckets already and is not exchanged."""
        name = f"line_{label}_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").option("path", shared_folder(self.spark, label))
        (writer.partitionBy(*parts) if parts else writer).bucketBy(self.buckets, "h").sortBy("h").saveAsTable(name)
        self.tables.append(name)
        return name

    def add(self, counts: DataFrame) -> None:
        """Count a new batch: without what is settled, it becomes a run of level 0."""
        new = counts.groupBy("h").agg(F.sum("n").alias("n"))
        if self.settled:
            new = new.join(self.spark.table(self.settled).select("h"), "h", "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self.store(new, "run"))
        level = 0
        while len(self.levels[level]) >= self.fan_out:
            self._compact(level)
            level += 1

    def _merged(self, names: list[str]) -> DataFrame:
        def rows(name: str) -> DataFrame:
            run = self.spark.table(name)
            # a compacted run's hashes at the threshold are in the settled run
            return run if name in self.levels[0] else run.where(F.col("n") < self.threshold)

        return reduce(DataFrame.unionAll, map(rows, names)).groupBy("h").agg(F.sum("n").alias("n"))

    def _compact(self, level: int) -> None:
        name = self.store(self._merged(self.levels[level]), "run")
        self.levels[level] = []
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(name)
        over = self.spark.table(name).where(F.col("n") >= self.threshold)
        if self.settled:
            over = self.spark.table(self.settled).unionAll(over).groupBy("h").agg(F.sum("n").alias("n"))
        self.settled = self.store(over, "settled")

    def frequent(self) -> DataFrame:
        """``h, n`` of all hashes counted ``threshold`` times or more; ``n`` of hashes that
        settled early is what it was then."""
        names = [n for level in self.levels for n in level]
        if not names:
            return self.spark.createDataFrame([], "h binary, n long")
        over = self._merged(names).where(F.col("n") >= self.threshold)
        if self.settled:
            over = over.unionAll(self.spark.table(self.settled)).groupBy("h").agg(F.sum("n").alias("n"))
        return over

    def drop(self) -> None:
        """Forget the tables (their files go with the shared folder)."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables = []


def _hot_floor(frequent: DataFrame, hot_keys: int) -> int:
    """The least power of two such that at most ``hot_keys`` hashes count as much."""
    sizes = frequent.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).count().collect()
    total, floor = 0, 64
    for p, n in sorted(((r[0], r[1]) for r in sizes), reverse=True):
        total += n
        if total > hot_keys:
            break
        floor = p
    return floor


def _drop_lines(hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = hot.value
        common = {block[i:i + 16] for i in range(0, len(block), 16)}
        for b in batches:
            rows = []
            for doc_id, text, more in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                gone, raw = common.union(more) if more else common, text.as_py()
                lines = raw.split(b"\n")
                kept = [line for line, h in zip(lines, line_hashes(raw)) if h is None or h not in gone]
                rows.append((doc_id, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KEPT.types)], schema=_KEPT)
    return run


def _asked(hot):
    """Distinct (text hash, line hash) of lines that are not among the commonest."""
    schema = pa.schema([("t", pa.binary()), ("h", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = hot.value
        common = {block[i:i + 16] for i in range(0, len(block), 16)} | {None}
        seen: set[bytes] = set()
        for b in batches:
            out = []
            for t, text in zip(b.column(0).to_pylist(), b.column(1)):
                if t not in seen:
                    seen.add(t)
                    out += [(t, h) for h in set(line_hashes(text.as_py())) - common]
            if len(seen) >= COMBINE:
                seen.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], schema=schema)
    return run


def drop_common_lines(docs: DataFrame, threshold: int = 10, batches: int = 6, fan_out: int = 3,
                      hot_keys: int = 1 << 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` with all lines gone whose key at least
    ``threshold`` documents hold."""
    spark = prepare(docs.sparkSession)
    runs = LineRuns(spark, threshold, fan_out)
    try:
        counted = runs.store(line_counts(docs, batches, text).repartition(runs.buckets, "h"), "batches", "batch")
        for batch in range(batches):
            runs.add(spark.table(counted).where(F.col("batch") == batch).select("h", "n"))
        frequent = written(runs.frequent(), "frequent")
    finally:
        runs.drop()
    floor = _hot_floor(frequent, hot_keys)
    is_hot = F.floor(F.log2("n")) >= floor
    block = b"".join(frequent.where(is_hot).select("h").toArrow().column(0).to_pylist())
    hot = spark.sparkContext.broadcast(block)
    rest = frequent.where(~is_hot).select("h")

    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), content.alias("text"))
    none = F.lit(None).cast("array<binary>")
    if rest.isEmpty():
        asked = rows.withColumn("more", none)
    else:
        ident = F.unhex(F.sha2("text", 256))
        pairs = rows.select(ident.alias("t"), "text").mapInArrow(_asked(hot), "t binary, h binary").distinct()
        more = pairs.join(rest, "h").groupBy("t").agg(F.collect_set("h").alias("more"))
        asked = rows.withColumn("t", ident).join(more, "t", "left").select("doc_id", "text", "more")
    return asked.mapInArrow(_drop_lines(hot), "doc_id long, n_lines long, n_dropped long, text string")


def line_digests(cleaned: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of :func:`drop_common_lines`' rows."""
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
