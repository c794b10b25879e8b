"""Word shingles as sets of 64-bit hashes, computed in batches on the workers."""

from __future__ import annotations

import numpy as np
import xxhash

from kawara.llm.common import SHINGLE

WORD_CACHE = 100_000
LONGEST = 64  # bytes of a word that is kept
_MUL = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash; emptied when full, and long words are not kept, so its size is bounded."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = value
        return value


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased (``bytes.lower`` knows no other letters), cut at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash per run of ``k`` words, in order."""
    n = len(hashes) - k + 1
    acc = np.full(max(n, 0), k, np.uint64)
    for j in range(k if n > 0 else 0):
        acc = (acc ^ hashes[j : j + n]) * _MUL
        acc ^= acc >> np.uint64(29)
    return acc


def shingle_set(text: str | None, cache: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, an empty one has none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(rolling(word_hashes(words, cache), min(k, len(words))))


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())
