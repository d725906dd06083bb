"""Operator 13: importance resampling towards a target distribution.

Documents are drawn so that their hashed n-grams come nearer to those of a target set: every
feature falls into a bucket by the CRC-32 of its text, bucket counts of all documents and of
all target texts give a gain per bucket, a document's weight is its mean gain, and weights
plus Gumbel noise are ranked.

Features are never built as strings.  A task's automaton (Aho-Corasick) holds distinct words,
bounded by a delimiter on either side; a match emits the word's payload, its CRC and length.
Payloads of neighbouring words compose: crc(a + " " + b) follows from the two CRCs and the
length of what stands behind, so buckets of runs of any number of words come from arrays of
payloads.  The dictionary grows as the task reads: words seen for the first time are read off
the text and enter the automaton at its next building (when they are a quarter of it); beyond
``dictionary_words`` the dictionary stays and other words are read off.  Either way the
payloads are the same, so results do not depend on the dictionary.

Counting and scoring see the same features: one scan writes each document's buckets, both read
those.  Counts are ``buckets`` sums; ranks come from a distributed sort of narrow rows.

Defined results: null or empty texts have no features and weight 0; a null
doc_id hashes as an empty one; rows that tie in score and id take ranks in any order; empty
tables give no rows (documents) or zero counts (target); extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.llm.common import prepare, written
from sentispark.operators.ranking import global_row_number

#: Bytes to bytes: A-Z to lower case, word bytes (0-9, a-z, 0x80 and above) as they are, others to blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_FEATURES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.binary())])
FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


class Shifts:
    """``crc(a + b) = shifted(crc(a), len(b)) ^ crc(b)``: the linear map of appending zero
    bytes, as byte-indexed tables of its powers of two."""

    def __init__(self, bits: int = 24):
        def spread(columns: np.ndarray) -> np.ndarray:
            tables = np.zeros((4, 256), np.uint32)
            for i in range(32):
                tables[i // 8] ^= np.where(np.arange(256) >> (i % 8) & 1, columns[i], 0).astype(np.uint32)
            return tables

        # one zero byte, by definition: crc32(x + b"\0") without its constant part
        unit = [int.from_bytes((1 << i).to_bytes(4, "little"), "little") for i in range(32)]
        zero = zlib.crc32(b"\0", 0)
        self.tables = [spread(np.array([zlib.crc32(b"\0", u) ^ zero for u in unit], np.uint32))]
        for _ in range(bits - 1):
            last = self.tables[-1]
            self.tables.append(spread(self.apply(last, self.apply(last, np.array(unit, np.uint32)))))

    @staticmethod
    def apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return (tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24])

    def shifted(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        for k, tables in enumerate(self.tables):
            on = length >> k & 1 > 0
            if on.any():
                crc = np.where(on, self.apply(tables, crc), crc)
        return crc


class Dictionary:
    """Distinct words with payloads (CRC, length) in an automaton that grows with what it reads."""

    def __init__(self, limit: int):
        self.limit, self.automaton, self.built, self.fresh = limit, None, 0, {}
        self.crc, self.length = np.zeros(1024, np.uint32), np.zeros(1024, np.int64)

    def _learn(self, word: bytes) -> None:
        n = self.built + len(self.fresh)
        if word in self.fresh or n >= self.limit:
            return
        if n == len(self.crc):
            self.crc, self.length = np.resize(self.crc, 2 * n), np.resize(self.length, 2 * n)
        self.crc[n], self.length[n] = zlib.crc32(word), len(word)
        self.fresh[word] = n

    def _build(self) -> None:
        automaton = self.automaton or ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word, n in self.fresh.items():
            automaton.add_word(f" {word.decode('latin-1')} ", n)
        automaton.make_automaton()
        self.automaton, self.built, self.fresh = automaton, self.built + len(self.fresh), {}

    def payloads(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """CRC and length of every word of the text, in order."""
        folded = b" " + text.translate(FOLD) + b" "
        blank = np.frombuffer(folded, np.uint8) == 32
        ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1  # the blank behind each word
        crc, length = np.empty(len(ends), np.uint32), np.empty(len(ends), np.int64)
        if not len(ends):
            return crc, length
        rest = np.ones(len(ends), bool)
        if self.built:
            # one character per byte, so places are those of the bytes
            hits = np.fromiter(chain.from_iterable(self.automaton.iter(folded.decode("latin-1"))), np.int64).reshape(-1, 2)
            at = np.searchsorted(ends, hits[:, 0])
            crc[at], length[at], rest[at] = self.crc[hits[:, 1]], self.length[hits[:, 1]], False
        if rest.any():
            starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
            for i in np.flatnonzero(rest).tolist():
                word = folded[starts[i]:ends[i]]
                crc[i], length[i] = zlib.crc32(word), len(word)
                self._learn(word)
            if len(self.fresh) > max(256, self.built // 4):
                self._build()
        return crc, length


def buckets_of(crc: np.ndarray, length: np.ndarray, shifts: Shifts, buckets: int, max_words: int) -> np.ndarray:
    """Buckets of all runs of 1 to ``max_words`` neighbouring words, joined by one blank."""
    blank = np.uint32(zlib.crc32(b" "))
    out, run = [crc % np.uint32(buckets)], crc
    for k in range(1, max_words):
        if len(crc) <= k:
            break
        # append a blank, then the k-th word behind
        run = shifts.shifted(run[:-1], np.ones(len(run) - 1, np.int64)) ^ blank
        run = shifts.shifted(run, length[k:]) ^ crc[k:]
        out.append(run % np.uint32(buckets))
    return np.concatenate(out)


def _features(buckets: int, max_words: int, dictionary_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shifts = Dictionary(dictionary_words), Shifts()
        for b in batches:
            rows, held = [], 0
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                crc, length = words.payloads(text.as_py())
                at = buckets_of(crc, length, shifts, buckets, max_words)
                rows.append((doc_id, len(crc), len(at), at.astype("<u4").tobytes()))
                held += 4 * len(at)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FEATURES.types)], schema=_FEATURES)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FEATURES.types)], schema=_FEATURES)
    return run


def features(texts: DataFrame, key: str, text: str = "text", buckets: int = 10_000, max_words: int = 1,
             dictionary_words: int = 200_000) -> DataFrame:
    """``doc_id, n_words, n_features, buckets`` (little-endian unsigned 32-bit) of every row."""
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return texts.select(F.col(key).cast("long").alias("doc_id"), content.alias("text")).mapInArrow(
        _features(buckets, max_words, dictionary_words), FEATURES)


def _count(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for held in b.column(0):
                total += np.bincount(np.frombuffer(held.as_buffer(), "<u4"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], schema=schema)
    return run


def bucket_counts(featured: DataFrame, buckets: int) -> list[int]:
    """Features by bucket: partial sums in the tasks, ``buckets`` rows to the driver."""
    parts = featured.select("buckets").mapInArrow(_count(buckets), "bucket int, n long")
    out = [0] * buckets
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln of the smoothed ratio of frequencies) by bucket, in doubles."""
    s_all, t_all = (float(sum(counts) + len(documents)) for counts in (documents, target))
    return [math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for s, t in zip(documents, target)]


def _score(gain: list[int], seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()),
                        ("weight", pa.int64()), ("score", pa.int64())])

    def noise(doc_id: int | None) -> int:
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.int64)
        for b in batches:
            ids, n = b.column(0).to_pylist(), b.column(2).to_pylist()
            weight = [int(table[np.frombuffer(held.as_buffer(), "<u4")].sum()) // k if k else 0 for held, k in zip(b.column(3), n)]
            score = [w + noise(i) for i, w in zip(ids, weight)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(weight, pa.int64()), pa.array(score, pa.int64())], schema=schema)
    return run


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, buckets: int = 10_000,
             max_words: int = 1, seed: int = 2024, key: str = "doc_id", dictionary_words: int = 200_000) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``: ``rank`` counts
    the ``percent`` % of the documents of ``least_words`` words that are drawn, null for others.
    ``target`` has a column ``text``."""
    prepare(docs.sparkSession)
    options = {"buckets": buckets, "max_words": max_words, "dictionary_words": dictionary_words}
    featured = written(features(docs, key, **options), "features")
    wanted = features(target.select(F.lit(0).alias("of"), "text"), "of", **options)
    gain = gains(bucket_counts(featured, buckets), bucket_counts(wanted, buckets))
    scored = written(featured.mapInArrow(
        _score(gain, seed), "doc_id long, n_words long, n_features long, weight long, score long"), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    ranked = global_row_number(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")
