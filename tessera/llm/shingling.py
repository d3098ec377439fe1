"""Words and word n-grams as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
#: Odd multipliers by position in an n-gram.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                        0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9], dtype=U)
MEMO = 500_000


class WordHashes(dict):
    """64-bit hash of each word (bytes); a bounded memo."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram (n from 1 to 9) at each position that has one."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, U)
    out = np.full(size, n, U)
    for i in range(n):
        out += hashes[i:i + size] * MULTIPLIERS[i]
    return mix(out)
