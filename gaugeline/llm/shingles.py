"""Words and word shingles of texts as 64-bit codes."""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 400_000


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case; null has none."""
    return text.encode().lower().split() if text else []


class WordCodes(dict):
    """64-bit codes of words; a bounded number of them is kept."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = code
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits (the finisher of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_codes(words: list[bytes], codes: WordCodes, width: int = 2) -> np.ndarray:
    """Sorted codes of the distinct shingles of ``width`` words; fewer words are one shingle."""
    x = codes.of(words)
    width = min(width, len(x))
    if len(x) > 1:
        last = len(x) - width + 1
        out = x[:last]
        for k in range(1, width):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + mixed(x[k : last + k]))
        x = np.sort(out)
        x = x[np.concatenate(([True], x[1:] != x[:-1]))]
    return x
