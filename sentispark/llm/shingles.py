"""Word-shingle sets as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_P = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash, kept for the task (bounded)."""

    def __missing__(self, word: bytes | str) -> int:
        if len(self) >= 250_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(texts: list[str], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text starts (one more at the end)."""
    lists = [words_of(t) for t in texts]
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    flat = np.fromiter((cache[w] for ws in lists for w in ws), np.uint64, int(starts[-1]))
    return flat, starts


def rolling(flat: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on (places up to ``len - k``)."""
    n = max(0, len(flat) - k + 1)
    h = np.full(n, k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            h = h * _P + flat[i:i + n]
        return mix(h)


def shingle_sets(texts: list[str], cache: WordHashes, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingles (int64) of each text; a text of fewer
    words is one shingle, a text without words none."""
    flat, starts = word_hashes(texts, cache)
    h = rolling(flat, k).view(np.int64)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(h[a:b - k + 1]))
        else:
            out.append(rolling(flat[a:b], b - a).view(np.int64) if b > a else np.zeros(0, np.int64))
    return out
