"""Operator 6: mixture-controlled packing by deficit round-robin.

Every source is a queue of tokens.  Each window of ``window`` tokens is one
round: every source is credited its share of the window, is served whole
tokens from its credit, and carries the rest, its deficit, into the next
window; the tokens that whole credits leave over go to the sources with the
largest deficits.  Served token by token that is the order of the numbers
``(2j + 1) / (2 share)`` over all tokens j of all sources (ties: the source's
number), so what any source has been served when window w opens follows from w
alone.  Windows in different partitions therefore need no state from each
other: :class:`Rounds` computes the deficits carried into any window, and the
result is one sequential run's, cut anywhere.

Documents are tokenised once into a table in the shared folder; a document's
place in its queue is its place in its partition's share of the queue plus
the partition's offset (one row per partition and source); pieces are
then cut where they lie, with no exchange of token ids.

The last, shorter window is written as sequences of falling powers of two,
which need no padding; all others are full.

Defined results: null text is empty (the end token alone); a null source is
the queue ``''``; a source whose queue is empty leaves its credit to the others;
repeated rows are documents of their own; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentispark.llm.common import text_or_empty, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1
#: Offsets (one row per partition and source, 40 bytes) are broadcast up to here, joined by shuffle beyond.
BROADCAST_ROWS = 500_000

_ENCODERS: dict = {}


def encoder(path: str):
    """Text -> ids (numpy) of a byte-level BPE file of the ``tokenizers`` library.  The
    file's vocabulary is run by tiktoken's merge loop (same ids, a third of the
    CPU).  The file's added tokens get their own ids where a text holds them, as the library does."""
    if path not in _ENCODERS:
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens", ())
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("added tokens that depend on what stands around them are not supported")
        special = {t["content"]: t["id"] for t in sorted(added, key=lambda t: -len(t["content"]))}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in special}
        if max(*ranks.values(), *special.values()) > 0xFFFF:
            raise ValueError("token ids are kept in 16 bits")
        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens=special)
    enc = _ENCODERS[path]
    return lambda text: enc.encode_to_numpy(text, allowed_special="all")


_TOKENS = "doc_id long, source string, pid int, start long, n long, ids binary"


def tokenised(docs: DataFrame, path: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, source, pid, start, n, ids`` (little-endian uint16): ``start`` counts
    the tokens of the source before the document in its partition ``pid``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pid, seen = encoder(path), TaskContext.get().partitionId(), {}
        schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("pid", pa.int32()),
                            ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                starts, sizes, ids = [], [], []
                for source, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    got = encode(text)
                    starts.append(seen.get(source, 0))
                    sizes.append(len(got) + 1)
                    seen[source] = starts[-1] + sizes[-1]
                    ids.append(np.append(got, np.uint32(end_id)).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([pid] * len(ids), pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("source"),
                       text_or_empty().alias("text")).mapInArrow(run, _TOKENS)


class Rounds:
    """Deficit round-robin over queues of ``totals`` tokens with target ``shares``."""

    def __init__(self, totals, shares, window: int):
        self.t = np.asarray(totals, np.int64)
        self.w = np.asarray(shares, np.float64) / np.sum(shares) * max(1, self.t.sum())
        self.window, self.total = window, int(self.t.sum())
        # fill curve: tokens served by time v is the sum of min(t, w v)
        stops = np.unique(np.concatenate([[0.0], (self.t + 1) / self.w]))
        self.curve = np.minimum(self.t, self.w * stops[:, None]).sum(1), stops

    def key(self, j, s):
        return (2 * j + 1) / (2 * self.w[s])

    def served(self, windows: np.ndarray) -> np.ndarray:
        """Tokens of every source in the windows before each of ``windows``:
        the first ``window * w`` tokens in the order (key, source)."""
        goal = np.minimum(np.asarray(windows, np.int64) * self.window, self.total)
        s = np.arange(len(self.t))
        c = np.minimum(self.t, np.floor(self.w * np.interp(goal, *self.curve)[:, None] + 0.5).astype(np.int64))
        todo = np.arange(len(goal))
        while len(todo):
            now = c[todo]
            nxt = np.where(now < self.t, self.key(now, s), np.inf)
            last = np.where(now > 0, self.key(now - 1, s), -np.inf)
            low, high = nxt.argmin(1), len(s) - 1 - last[:, ::-1].argmax(1)
            r = np.arange(len(todo))
            gap = goal[todo] - now.sum(1)
            a, b = nxt[r, low], last[r, high]
            swap = (gap == 0) & ((b > a) | ((b == a) & (high > low)))
            c[todo[(gap > 0) | swap], low[(gap > 0) | swap]] += 1
            c[todo[(gap < 0) | swap], high[(gap < 0) | swap]] -= 1
            todo = todo[(gap != 0) | swap]
        return c

    def rank(self, s: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Place of token j of source s in the order of all tokens."""
        key, out = self.key(j, s), np.zeros(len(j), np.int64)
        for other in range(len(self.t)):
            n = np.clip(np.floor(self.w[other] * key + 0.5).astype(np.int64), 0, self.t[other])
            while True:
                k = self.key(n, other)
                up = (n < self.t[other]) & ((k < key) | ((k == key) & (other < s)))
                k = self.key(n - 1, other)
                down = (n > 0) & ~((k < key) | ((k == key) & (other < s)))
                if not (up.any() or down.any()):
                    break
                n = n + up - (down & ~up)
            out += n
        return out


def tail_parts(tokens: int, window: int) -> list[tuple[int, int]]:
    """``(offset, length)`` of the powers of two that the last window is cut into."""
    parts, at = [], 0
    for bit in reversed(range(window.bit_length())):
        if tokens >> bit & 1:
            parts.append((at, 1 << bit))
            at += 1 << bit
    return parts


def cut(rounds: Rounds, source: np.ndarray, first: np.ndarray, size: np.ndarray):
    """Pieces of documents at ``[first, first + size)`` of their queues: arrays
    ``(document, start, length, sequence, offset)``."""
    w0 = rounds.rank(source, first) // rounds.window
    w1 = rounds.rank(source, first + size - 1) // rounds.window
    doc, win = [], []
    for i in range(len(first)):
        if w1[i] - w0[i] > size[i]:  # a source of tiny share: most windows hold none of it
            j = np.arange(first[i], first[i] + size[i])
            own = np.unique(rounds.rank(np.full(len(j), source[i]), j) // rounds.window)
        else:
            own = np.arange(w0[i], w1[i] + 1)
        win.append(own)
        doc.append(np.full(len(own), i))
    doc, win = np.concatenate(doc), np.concatenate(win)
    need, at = np.unique(win, return_inverse=True)
    opened, closed = rounds.served(need), rounds.served(need + 1)
    before = np.cumsum(closed - opened, 1) - (closed - opened)
    s = source[doc]
    start = np.maximum(first[doc], opened[at, s])
    end = np.minimum(first[doc] + size[doc], closed[at, s])
    some = end > start
    doc, win, start, end, at, s = (x[some] for x in (doc, win, start, end, at, s))
    offset = before[at, s] + start - opened[at, s]
    start, length = start - first[doc], end - start
    full, tail = divmod(rounds.total, rounds.window)
    ready = win < full
    rows = [(doc[ready], start[ready], length[ready], win[ready], offset[ready])]
    for k, (lo, n) in enumerate(tail_parts(tail, rounds.window)):
        a, b = np.maximum(offset, lo), np.minimum(offset + length, lo + n)
        hit = ~ready & (b > a)
        rows.append((doc[hit], (start + a - offset)[hit], (b - a)[hit], np.full(hit.sum(), full + k), (a - lo)[hit]))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*rows))


_PIECES = ("doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, "
           "offset long, ids binary")


def pack(tokens: DataFrame, window: int = 2048, shares: Mapping[str, float] | None = None) -> DataFrame:
    """Pieces of a table made by :func:`tokenised`: ``doc_id, source, start, length,
    doc_tokens, sequence_id, offset, ids`` (little-endian uint32); the pieces of a sequence, by offset, are the
    sequence.  ``shares``: target proportions by source (others get none until the
    named queues are empty); by default each source's share of all tokens, with
    which all queues run dry together."""
    spark = tokens.sparkSession
    part = tokens.groupBy("pid", "source").agg(F.sum("n").alias("__n"))
    before = Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(part.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))), "queues")
    totals = {r[0]: r[1] for r in offsets.groupBy("source").agg(F.sum("__n")).collect()}
    names = sorted(totals)
    if not names:
        return spark.createDataFrame([], _PIECES)
    wish = [shares.get(x, 0) if shares else totals[x] for x in names]
    rounds = Rounds([totals[x] for x in names], [max(x, 1e-12 * sum(wish)) for x in wish], window)
    number = {x: i for i, x in enumerate(names)}
    small = offsets.drop("__n")
    if small.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    placed = tokens.join(small, ["pid", "source"]).select("doc_id", "source", "n", "ids",
                                                          (F.col("start") + F.col("__before")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()),
                            ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                            ("offset", pa.int64()), ("ids", pa.binary())])
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                source = np.array([number[x] for x in b.column(1).to_pylist()], np.int64)
                sizes = b.column(2).to_numpy()
                doc, start, length, seq, offset = cut(rounds, source, b.column(4).to_numpy(), sizes)
                ids = [np.frombuffer(x, "<u2").astype("<u4") for x in b.column(3).to_pylist()]
                held = [ids[d][a:a + n].tobytes() for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist())]
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array(start), pa.array(length),
                     pa.array(sizes[doc]), pa.array(seq), pa.array(offset), pa.array(held, pa.binary())], schema=schema)

    return placed.mapInArrow(run, _PIECES)


def pack_documents(docs: DataFrame, path: str = VOCABULARY, window: int = 2048,
                   shares: Mapping[str, float] | None = None) -> DataFrame:
    return pack(written(tokenised(docs, path), "tokens", "zstd"), window, shares)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "source")
