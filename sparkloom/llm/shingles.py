"""Word shingles of whole texts as sets of 64-bit hashes (numpy inside Spark tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles of ``text``.

    Words are runs outside space and U+0009 to U+000D with A-Z lowered; a
    shorter text has its whole sequence as its one shingle; null, empty or
    blank texts have none.
    """
    if not text:
        return np.empty(0, np.uint64)
    # on bytes, lower() touches A-Z alone and split() cuts at exactly those blanks
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, text.encode("utf-8", "surrogatepass").lower().split()), np.uint64)
    if not len(w):
        return w
    k = min(words, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = h * MULTIPLIER + w[i : len(w) - k + 1 + i]
    return np.unique(mix(h))
