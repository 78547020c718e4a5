"""64-bit hashes of words, and mixing of hashes into those of n-grams."""

from __future__ import annotations

import numpy as np
import xxhash

# Words whose hashes a worker keeps; with more, it starts anew.
KEPT_WORDS = 100_000


class WordHash(dict):
    """64-bit hashes of words, each computed once while it is kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


# The hashes that this Python worker keeps.
WORDS = WordHash()
# Odd numbers without pattern: a step of a run's polynomial, and its last spreading.
_RUN, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(32), np.uint64(29))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits, so that sums of them may be hashed on."""
    a, b, s, t = _MIX
    h = (h ^ (h >> s)) * a
    h = (h ^ (h >> t)) * b
    return h ^ (h >> s)


def character_runs(text: str, buckets: int, length: int = 4) -> np.ndarray:
    """Bucket (of a power of two) of every run of ``length`` characters of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = points.size - length + 1
    if n < 1:
        return np.empty(0, np.int64)
    h = points[:n].copy()
    for k in range(1, length):
        h *= _RUN
        h += points[k : k + n]
    h *= _SPREAD
    return (h >> np.uint32(33 - buckets.bit_length())).astype(np.int64)
