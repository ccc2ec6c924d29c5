"""Words as a reader sees them, and stable hashes of them."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from .canon import canonical

WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits of the canonical form, in lower case."""
    return WORD.findall(canonical(text).lower()) if text else []


class WordHashes(dict):
    """word to 64-bit hash, remembered for the words of a task; forgets when it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` successive words, in order; a shorter text is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < size:
        hashes = np.concatenate([hashes, np.zeros(size - n, np.uint64)])
        n = size
    out = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        out = (out + hashes[j : n - size + 1 + j]) * MIX[j % len(MIX)]
        out ^= out >> np.uint64(29)
    return scramble(out)
