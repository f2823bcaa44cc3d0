"""Words and shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

P = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 300_000


class WordHashes(dict):
    """bytes -> 64-bit hash; forgets all once it holds CACHED_WORDS, so that a task's memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def plain_words(text: str | None) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+ after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of width hashes; of the whole sequence if it is shorter; none if it is empty."""
    width = min(width, len(hashes))
    if not width:
        return hashes
    n = len(hashes) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = out * P + hashes[i : i + n]
    return mix(out)


def shingle_set(text: str | None, width: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(windows(cache.of(plain_words(text)), width))
