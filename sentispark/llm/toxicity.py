"""Operator 4: toxicity by a factorization machine over hashed terms.

A text's terms are its distinct lower-case words and their first
``PREFIX`` letters, hashed into ``2^bits`` buckets.  The machine scores
``w0 + sum_i w_i + sum_{i<j} <v_i, v_j>`` over the buckets a text holds, so a
pair of terms (an insult with a group's name) can count for more than its
two linear weights.  The pair sum costs one pass: half of ``|sum v|^2 - sum |v|^2``.

Fitting uses a bounded sample of the labelled training rows: rows whose hash
of ``doc_id`` lies below a threshold set so that about ``sample_rows`` of them remain
(all of them if there are fewer).  Their buckets, not their texts, go to the driver.
Fitted is every bucket with support that passes a significance test (:func:`telling_buckets`): how
far its holders' share of label 1 is from that of all rows, or the same of a pair with another
bucket in excess of either's own, each against the number of tests made.  So buckets that tell nothing cannot be
overfitted, and no number of buckets is fixed.  The fit is Adagrad on mini-batches.  Scoring is one Arrow pass over whole texts; nothing is
shuffled.

Defined results: null and empty texts hold no terms and score the prior; rows
without a label, or with a null one, don't train; without labelled rows of
both classes the score is the smoothed share of label 1; repeated rows score
alike; an empty table gives no rows; columns other than the text are never inputs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.llm.common import unused_name

PREFIX = 4
BITS = 18
_WORD = re.compile(r"\w+")
_CACHE: dict[str, tuple[int, int]] = {}
_CACHE_WORDS = 1_000_000


def word_buckets(word: str, bits: int = BITS) -> tuple[int, int]:
    """Buckets of the word and of its prefix (its own key space)."""
    mask = (1 << bits) - 1
    return (zlib.crc32(word.encode("utf-8", "replace")) & mask,
            zlib.crc32(b"^" + word[:PREFIX].encode("utf-8", "replace")) & mask)


def _buckets(text: str) -> set[int]:
    out: set[int] = set()
    for w in set(_WORD.findall(text.lower())):
        got = _CACHE.get(w)
        if got is None:
            if len(_CACHE) >= _CACHE_WORDS:
                _CACHE.clear()
            got = _CACHE[w] = word_buckets(w)
        out.update(got)
    return out


@dataclass
class Machine:
    w0: float
    buckets: np.ndarray  # fitted buckets, sorted
    w: np.ndarray
    v: np.ndarray

    def scores(self, texts: Iterator[str | None]) -> np.ndarray:
        """Probability of label 1 for each text."""
        at = np.full(1 << BITS, -1, np.int32)
        at[self.buckets] = np.arange(len(self.buckets))
        place: dict[str, tuple[int, ...]] = {}
        out = []
        for text in texts:
            own: set[int] = set()
            for w in set(_WORD.findall((text or "").lower())):
                got = place.get(w)
                if got is None:
                    if len(place) >= _CACHE_WORDS:
                        place.clear()
                    got = place[w] = tuple(i for i in at[list(word_buckets(w))].tolist() if i >= 0)
                if got:
                    own.update(got)
            i = np.fromiter(sorted(own), np.int64, len(own))
            s = self.v[i]
            out.append(self.w0 + self.w[i].sum() + 0.5 * ((s.sum(0) ** 2).sum() - (s * s).sum()))
        return 1 / (1 + np.exp(-np.clip(np.array(out, float), -30, 30)))


def _evidence(one: np.ndarray, df: np.ndarray, share: float) -> np.ndarray:
    """``df`` times the Kullback-Leibler divergence of the positive share among the ``df`` holders
    (``one`` of them positive) from ``share``: by Chernoff's bound, chance gives this much or more with
    probability below exp(-evidence), however few the holders."""
    with np.errstate(divide="ignore", invalid="ignore"):
        q = one / df
        up = np.where(one > 0, one * np.log(q / share), 0.0)
        down = np.where(one < df, (df - one) * np.log((1 - q) / (1 - share)), 0.0)
    return np.where(df > 0, up + down, 0.0)


def _cut(tests: int, chance: float) -> float:
    """Evidence that fewer than ``chance`` of ``tests`` tests are expected to give by chance."""
    return max(0.0, float(np.log(max(tests, 1) / chance)))


def telling_buckets(rows: list[np.ndarray], labels: np.ndarray, support: int = 3, chance: float = 20.0,
                    pair_chance: float = 0.05, pair_buckets: int = 1024) -> np.ndarray:
    """Buckets held by ``support`` rows or more that tell something about the label, alone or with
    another one; by chance fewer than ``chance`` and ``pair_chance`` are expected.  Pairs are tested among the ``pair_buckets`` most frequent buckets that at most half
    of the rows hold; a pair counts when it tells more than the better of its two."""
    n, pos = len(rows), int(labels.sum())
    one, df = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for r, y in zip(rows, labels):
        df[r] += 1
        if y:
            one[r] += 1
    able = np.flatnonzero((df >= support) & (df < n))
    alone = able[_evidence(one[able], df[able], pos / n) >= _cut(len(able), chance)]
    often = able[df[able] <= n / 2 + 0.05 * n]
    often = np.sort(often[np.argsort(-df[often], kind="stable")[:pair_buckets]])
    at = np.full(1 << BITS, -1, np.int64)
    at[often] = np.arange(len(often))
    both, both_one = np.zeros((2, len(often), len(often)))
    for lo in range(0, n, 2048):  # rows x buckets held at once
        held = np.zeros((len(rows[lo:lo + 2048]), len(often)), np.float32)
        for i, r in enumerate(rows[lo:lo + 2048]):
            held[i, at[r][at[r] >= 0]] = 1
        both += held.T @ held
        both_one += held.T @ (held * labels[lo:lo + 2048, None].astype(np.float32))
    pair = _evidence(both_one, both, pos / n)
    own = np.diag(pair)
    more = (pair - np.maximum(own[:, None], own[None, :]) >= _cut(len(often) ** 2 // 2, pair_chance)) & (both >= support)
    return np.union1d(alone, often[more.any(axis=0)])


def fit_machine(rows: list[np.ndarray], labels: np.ndarray, factors: int = 4,
                epochs: int = 12, rate: float = 0.1, l2: float = 1e-3, batch_rows: int = 64,
                least_steps: int = 800, balance: float = 0.5, seed: int = 7) -> Machine:
    """Fit on ``rows`` (each the buckets of one text) by Adagrad, in ``epochs`` passes or as many
    as make ``least_steps`` steps.  A class weighs in by its share of rows to the power -``balance``
    (0: rows count alike; 1: classes do)."""
    n, pos = len(rows), int(labels.sum())
    prior = float(np.log((pos + 0.5) / (n - pos + 0.5)))
    if pos == 0 or pos == n:
        return Machine(prior, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
    kept = telling_buckets(rows, labels)
    at = np.full(1 << BITS, -1, np.int64)
    at[kept] = np.arange(len(kept))
    own = [x[x >= 0] for x in (at[r] for r in rows)]
    weight = np.where(labels > 0, (n / (2 * pos)) ** balance, (n / (2 * (n - pos))) ** balance)
    rng = np.random.default_rng(seed)
    w0, w, v = prior, np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), factors))
    g0, gw, gv = 1e-8, np.full(len(w), 1e-8), np.full(v.shape, 1e-8)
    steps = max(1, n // batch_rows)
    for _ in range(max(epochs, -(-least_steps // steps))):
        for batch in np.array_split(rng.permutation(n), steps):
            idx = np.concatenate([own[b] for b in batch]) if len(batch) else np.zeros(0, np.int64)
            row = np.repeat(np.arange(len(batch)), [len(own[b]) for b in batch])
            s = np.zeros((len(batch), factors))
            np.add.at(s, row, v[idx])
            z = w0 + np.bincount(row, w[idx], len(batch))
            z += 0.5 * ((s * s).sum(1) - np.bincount(row, (v[idx] ** 2).sum(1), len(batch)))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) * weight[batch]
            d0 = err.mean()
            dw = np.bincount(idx, err[row], len(w)) / len(batch) + l2 * w
            dv = np.zeros_like(v)
            np.add.at(dv, idx, err[row, None] * (s[row] - v[idx]))
            dv = dv / len(batch) + l2 * v
            g0 += d0 * d0
            gw += dw * dw
            gv += dv * dv
            w0 -= rate * d0 / np.sqrt(g0)
            w -= rate * dw / np.sqrt(gw)
            v -= rate * dv / np.sqrt(gv)
    return Machine(float(w0), kept, w, v)


def held_out(key: str = "doc_id") -> Column:
    """Rows that never train: one in five by checksum of the id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Machine:
    """Fit on the training rows of ``labels`` (``doc_id, toxic``)."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic")
    share = min(1.0, sample_rows / max(1, usable.count()))
    limit = int(share * (1 << 32))
    chosen = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long")), 32) < F.lit(limit)
    sample = (docs.where(chosen).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
              .join(usable.where(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"buckets": [np.fromiter(sorted(_buckets(t)), "<i4").tobytes() for t in b["text"]],
                                "toxic": b["toxic"]})

    got = sample.mapInPandas(run, "buckets binary, toxic int").collect()
    # the order of collected rows is no input of the fit
    got.sort(key=lambda r: (bytes(r[0]), r[1]))
    return fit_machine([np.frombuffer(r[0], "<i4") for r in got], np.array([r[1] for r in got], float))


def toxicity_score(machine: Machine, text: str = "text") -> Column:
    """Column of scores in 0..1."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(machine.scores(texts))

    return score(F.coalesce(F.col(text), F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    machine = train_toxicity(docs, labels, sample_rows)
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity_score(machine).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """Documents that score below 0.5, all columns."""
    machine = train_toxicity(docs, labels, sample_rows)
    name = unused_name(docs, "score")
    return docs.withColumn(name, toxicity_score(machine)).where(F.col(name) < 0.5).drop(name)
