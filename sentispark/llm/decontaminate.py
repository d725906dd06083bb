"""Operator 10: benchmark decontamination by CGK embeddings and bit-sampling LSH.

An item of n words is looked for in every window of n words of every text, within
``floor(max_edit * n)`` word edits.  A CGK random walk copies a word sequence to one of
3n places -- at each place a shared random bit of the current word says whether to go
on to the next word -- so that few edits leave few places different.  Each repetition has
its own walk and samples ``sample`` of its first ``SPAN * n`` places (a walk ends after about
2n; what follows is padding, on which any two agree); a window and an item whose sampled words
agree collide.  The number of repetitions follows from the target recall and the share of
places that agree in the pairs looked for (simulated, at the most edits allowed: 0.44 to 0.58 of
those places for 58 to 15 words, and 99.7 % of pairs collide in 35 repetitions of three places).
Collisions are verified by an exact edit distance of the item against the text around the window;
what lies before and behind a verified place is searched again, so an item that stands there
several times is reported as often.

Walks are made only in windows that could match: k edits spoil at most 2k of the
item's word pairs, so a window needs ``n - 1 - 2k`` places whose word pair occurs in
items of about that length.  That filter loses nothing and costs one table look-up a word.

The items are a stated query set.  They travel to the tasks in blocks of ``ITEM_BLOCK``
items; texts are read once a block and nothing is shuffled.

Words are runs of word characters in lower case.  Defined results: null and empty texts
match nothing; items of fewer than ``LEAST_WORDS`` words (also null ones) match nothing, being no evidence;
repeated items match alike, repeated rows give equal rows; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.llm.common import text_or_empty, unused_name
from sentispark.llm.shingles import WordHashes, mix, rolling

MAX_EDIT = 0.2
#: Share of a walk's places that are sampled, in item lengths.
SPAN = 1.5
#: Words of all windows that are walked at once.
WALKED = 100_000
LEAST_WORDS = 5
ITEM_BLOCK = 50_000
TABLE_BITS = 22
#: Texts searched at once in a task.
TEXTS = 2000
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def repetitions(recall: float, agree: float, sample: int) -> int:
    """Repetitions after which a pair agreeing in ``agree`` of its places has collided
    with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agree ** sample))


def _walk(rows: np.ndarray, seeds: np.ndarray) -> Iterator[np.ndarray]:
    """CGK walks of all rows (word hashes) under all seeds at once: for each of three times
    as many places as words, the words copied there (seeds x rows; 0 past the end)."""
    m, n = rows.shape
    padded = np.concatenate([rows, np.zeros((m, 1), np.uint64)], 1).ravel()
    row, at = np.arange(m) * (n + 1), np.zeros((len(seeds), m), np.int64)
    for j in range(3 * n):
        word = padded[row + at]
        yield word
        # the shared random bit of a word at this place: the top bit of a multiply-shift hash
        with np.errstate(over="ignore"):
            a = mix(seeds * np.uint64(2 * n + 1) + np.uint64(2 * j + 1))[:, None]
            bit = (word ^ a) * (mix(a) | np.uint64(1)) >> np.uint64(63)
        at = np.minimum(at + bit.view(np.int64), n)


def cgk(rows: np.ndarray, seed: int) -> np.ndarray:
    """CGK embedding of each row into three times its length."""
    return np.stack([w[0] for w in _walk(rows, np.array([seed + 1], np.uint64))], 1)


def lsh_keys(rows: np.ndarray, reps: int, sample: int) -> np.ndarray:
    """LSH keys (repetitions x rows): hashes of the places that a repetition samples of its walk."""
    n = rows.shape[1]
    places = max(sample, int(SPAN * n))
    sampled: list[list[int]] = [[] for _ in range(places)]
    for rep in range(reps):
        for j in np.random.default_rng([n, rep]).choice(places, sample, replace=False):
            sampled[j].append(rep)
    seeds = np.arange(1, reps + 1, dtype=np.uint64)
    key = np.repeat(seeds[:, None], len(rows), 1)
    with np.errstate(over="ignore"):
        for own, word in zip(sampled, _walk(rows, seeds)):
            if own:
                key[own] = mix(key[own] ^ word[own]) * np.uint64(3)
    return key


def edit_end(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to any part of ``region``: ``(distance, start, end)``,
    the earliest end of those."""
    m = len(region)
    cost, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    step = np.arange(m + 1)
    for word in item:
        swap = cost[:-1] + (region != word)
        drop = cost[1:] + 1
        take = swap <= drop
        new = np.concatenate([[cost[0] + 1], np.where(take, swap, drop)])
        src = np.concatenate([[origin[0]], np.where(take, origin[:-1], origin[1:])])
        # insertions: the least of new[k] + (j - k) over k <= j
        low = np.minimum.accumulate(new - step)
        best = np.maximum.accumulate(np.where(new - step == low, step, 0))
        cost, origin = low + step, src[best]
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


def _places(target: np.ndarray, flat: np.ndarray, a: int, b: int, k: int) -> list[tuple[int, int, int]]:
    """Disjoint parts of ``flat[a:b]`` within ``k`` edits of ``target``: the best, then those on
    either side of it."""
    # k edits leave n - k of the item's words
    if b - a < len(target) - k or np.isin(target, flat[a:b]).sum() < len(target) - k:
        return []
    distance, start, end = edit_end(target, flat[a:b])
    if distance > k:
        return []
    return [*_places(target, flat, a, a + start, k), (a + start, a + end, distance), *_places(target, flat, a + end, b, k)]


class Items:
    """Items of one block, ready for look-up."""

    def __init__(self, items: list[tuple[int, str]], max_edit: float = MAX_EDIT, recall: float = 0.99,
                 agree: float = 0.5, sample: int = 3):
        cache = WordHashes()
        self.sample, self.reps = sample, repetitions(recall, agree, sample)
        self.ids, self.words = [], []
        for item_id, text in items:
            w = words(text or "")
            if len(w) >= LEAST_WORDS:
                self.ids.append(item_id)
                self.words.append(np.array([cache[x] for x in w], np.uint64))
        self.lengths = sorted({len(w) for w in self.words})
        self.edits = {n: int(max_edit * n) for n in self.lengths}
        self.pad = max(self.edits.values(), default=0)
        # up to 64 classes of lengths; a word pair knows the classes of the items that hold it
        self.klass = {n: i * 64 // max(64, len(self.lengths)) for i, n in enumerate(self.lengths)}
        pairs: dict[int, int] = {}
        for w in self.words:
            for h in rolling(w, 2).tolist():
                pairs[h] = pairs.get(h, 0) | 1 << self.klass[len(w)]
        self.pairs = np.array(sorted(pairs), np.uint64)
        self.pair_mask = np.array([pairs[h] for h in sorted(pairs)], np.uint64)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.pairs & np.uint64((1 << TABLE_BITS) - 1)] = True
        self._keys: dict[int, list[dict[int, list[int]]]] = {}

    def keys(self, n: int) -> list[dict[int, list[int]]]:
        """For each repetition: LSH key -> items of length n."""
        if n not in self._keys:
            own = [i for i, w in enumerate(self.words) if len(w) == n]
            got = []
            for keys in lsh_keys(np.stack([self.words[i] for i in own]), self.reps, self.sample).tolist():
                at: dict[int, list[int]] = {}
                for i, k in zip(own, keys):
                    at.setdefault(k, []).append(i)
                got.append(at)
            self._keys[n] = got
        return self._keys[n]

    def windows(self, flat: np.ndarray) -> dict[int, np.ndarray]:
        """Starts of the windows of each item length that the word-pair filter leaves."""
        h = rolling(flat, 2)
        hit = np.flatnonzero(self.table[h & np.uint64((1 << TABLE_BITS) - 1)])
        if not len(hit) or not len(self.pairs):
            return {}
        at = np.minimum(np.searchsorted(self.pairs, h[hit]), len(self.pairs) - 1)
        same = self.pairs[at] == h[hit]
        hit, masks = hit[same], self.pair_mask[at[same]]
        found, run = {}, {}
        for n in self.lengths:
            c = self.klass[n]
            if c not in run:
                run[c] = hit[(masks >> np.uint64(c) & np.uint64(1)).astype(bool)]
            own, least = run[c], n - 1 - 2 * self.edits[n]
            if len(own) < least or len(flat) < n:
                continue
            # a window holding ``least`` marked pairs starts at most n - 2 before the first of them
            span = own[least - 1:] - own[:len(own) - least + 1]
            first = own[:len(span)][span <= n - 2]
            last = own[least - 1:][span <= n - 2]
            if len(first):
                starts = np.unique(np.concatenate([np.arange(max(0, b - n + 2), a + 1) for a, b in zip(first.tolist(), last.tolist())]))
                found[n] = starts[starts <= len(flat) - n]
        return found

    def search(self, texts: list[str], cache: WordHashes) -> list[tuple[int, int, int, int, int]]:
        """``(text index, item id, start word, end word, distance)`` of all verified matches."""
        if not self.words:
            return []
        gap, parts, starts, at = np.zeros(self.pad + 1, np.uint64), [], [], 0
        for t in texts:  # texts apart by more unmatched words than any window may reach over
            w = words(t)
            parts += [np.fromiter(map(cache.__getitem__, w), np.uint64, len(w)), gap]
            starts.append(at + self.pad + 1)
            at += len(w) + self.pad + 1
        flat = np.concatenate([gap, *parts])
        bounds = np.array([*starts, len(flat)])
        hits: dict[tuple[int, int], set[int]] = {}
        for n, s in self.windows(flat).items():
            chunk = max(16, min(4000, WALKED // n))
            for lo in range(0, len(s), chunk):
                own = s[lo:lo + chunk]
                # the text that a window's middle lies in
                docs = np.maximum(np.searchsorted(bounds, own + n // 2, "right") - 1, 0).tolist()
                keys = lsh_keys(flat[own[:, None] + np.arange(n)], self.reps, self.sample)
                for table, row in zip(self.keys(n), keys):
                    at = np.flatnonzero(np.isin(row, np.fromiter(table, np.uint64, len(table))))
                    for w, k in zip(at.tolist(), row[at].tolist()):
                        for item in table[k]:
                            hits.setdefault((docs[w], item), set()).add(int(own[w]))
        out = []
        for (doc, item), where in sorted(hits.items()):
            target = self.words[item]
            n, k = len(target), self.edits[len(target)]
            lo_doc, hi_doc = int(bounds[doc]), int(bounds[doc + 1]) - (self.pad + 1 if doc + 1 < len(starts) else self.pad + 1)
            where, i = sorted(where), 0
            while i < len(where):  # windows that overlap are verified at once
                j = i
                while j + 1 < len(where) and where[j + 1] - where[j] <= n:
                    j += 1
                a, b = max(lo_doc, where[i] - k), min(hi_doc, where[j] + n + k)
                out += [(doc, self.ids[item], x - lo_doc, y - lo_doc, d) for x, y, d in _places(target, flat, a, b, k)]
                i = j + 1
        return out


def item_blocks(items: DataFrame, block: int = ITEM_BLOCK) -> list[list[tuple[int, str]]]:
    """The query set in blocks, each small enough to travel with a task."""
    rows = items.select(F.col("item_id").cast("long"), "text").where("text is not null")
    count = rows.count()
    parts = max(1, -(-count // block))
    slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return [sorted(((r[0], r[1]) for r in rows.where(slot == p).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
            for p in range(parts)]


def find_leaks(docs: DataFrame, items: DataFrame, **search: float) -> DataFrame:
    """``doc_id, item_id, start, stop, distance``: places (words) of texts that hold an item."""
    out = None
    for block in item_blocks(items):
        def run(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            index, cache = Items(block, **search), WordHashes()
            for b in batches:
                for lo in range(0, len(b), TEXTS):
                    part = b.iloc[lo:lo + TEXTS]
                    ids = part["doc_id"].tolist()
                    rows = [(None if pd.isna(ids[d]) else int(ids[d]), *rest) for d, *rest in index.search(part["text"].tolist(), cache)]
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "stop", "distance"]).astype({"doc_id": "Int64", "item_id": "Int64"})

        found = (docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
                 .mapInPandas(run, "doc_id long, item_id long, start long, stop long, distance long"))
        out = found if out is None else out.unionAll(found)
    return out


def _holds(block: list[tuple[int, str]], search: dict):
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, cache = Items(block, **search), WordHashes()
        for texts in batches:
            hit = np.zeros(len(texts), bool)
            for lo in range(0, len(texts), TEXTS):
                for d, *_ in index.search(texts.iloc[lo:lo + TEXTS].tolist(), cache):
                    hit[lo + d] = True
            yield pd.Series(hit)

    return holds


def leaked(items: DataFrame, text: str = "text", **search: float) -> Column:
    """Boolean column: the text holds a benchmark item."""
    out = F.lit(False)
    for block in item_blocks(items):
        out = out | _holds(block, search)(F.coalesce(F.col(text), F.lit("")))
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, **search: float) -> DataFrame:
    """Documents that hold no benchmark item, all columns."""
    name = unused_name(docs, "leaked")
    return docs.withColumn(name, leaked(items, **search)).where(~F.col(name)).drop(name)
