"""Words of a text as arrays of hashes, for operators that work on word sequences.

A word is a run of anything but the six ASCII white-space characters. Its hash has 64 bits; a sequence of words has a polynomial hash over the hashes of its words, modulo
2**64. Windows of one length are compared by two such hashes where pairs are many.
"""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 400_000  # bound of a worker's word table; beyond, it starts afresh
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Word -> 64 bits, remembered up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None, fold: bool = False) -> list[bytes]:
    """``bytes.split`` parts at exactly space and 0x09-0x0D; ``bytes.lower`` folds A-Z only."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if fold else data).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of each ``size`` consecutive words, from the first to the last full window."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    step = np.uint64(base)
    for i in range(size):
        out = out * step + hashes[i : i + n]
    return mixed(out)


class Prefixes:
    """Hashes of any stretch of one word sequence, from running sums."""

    def __init__(self, hashes: np.ndarray, base: int):
        n = len(hashes)
        powers = np.full(n + 1, np.uint64(base), np.uint64)
        powers[0] = 1
        self.powers = np.multiply.accumulate(powers)
        inverse = np.full(n + 1, np.uint64(pow(base, -1, 1 << 64)), np.uint64)
        inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.powers[:n], out=self.sums[1:])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words ``start`` to ``end``, exclusive; the length takes part in it."""
        inner = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mixed(inner + mixed((end - start).astype(np.uint64)))
