"""64-bit hashes of words and of runs of words, for use inside a task."""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_TOO = np.uint64(0xC2B2AE3D27D4EB4F)


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """Hash of each word; words seen before come from a bounded memory."""

    def __init__(self, kept: int = 500_000):
        import xxhash

        self._digest, self._kept, self._known = xxhash.xxh3_64_intdigest, kept, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > self._kept:
            known.clear()
        found = list(map(known.get, words))
        if None in found:
            digest = self._digest
            for w, h in zip(words, found):
                if h is None and w not in known:
                    known[w] = digest(w)
            found = list(map(known.get, words))
        return np.array(found, np.uint64)


def runs(hashes: np.ndarray, length: int, mix: np.uint64 = MIX) -> np.ndarray:
    """Hash of every run of ``length`` words, by its first word; none if there are fewer words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(length):
        h = h * mix + hashes[j : j + n]
        h ^= h >> np.uint64(32)
    return scramble(h)


def shingle_hashes(hashes: np.ndarray, length: int = 5) -> np.ndarray:
    """Runs of ``length`` words; with fewer words, all of them as one run. One entry per place."""
    if 0 < len(hashes) < length:
        length = len(hashes)
    return runs(hashes, length)
