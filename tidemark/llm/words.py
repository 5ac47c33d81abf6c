"""Words of a text as 64-bit hashes: A-Z lower-cased, cut at ASCII white space."""

from __future__ import annotations

import numpy as np
import xxhash


def word_hashes(text: str | None) -> np.ndarray:
    """The hash of each word. Hashing one costs less than looking it up in a memory of words."""
    # bytes.lower() and bytes.split() know ASCII letters and ASCII white space only
    words = text.encode().lower().split() if text else []
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return np.unique(h)
