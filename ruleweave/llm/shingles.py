"""Word shingles as 64-bit hashes, in numpy."""

from __future__ import annotations

import hashlib
import re

import numpy as np

from ruleweave.llm.common import held

WORDS = 5
_SEPARATORS = bytes(range(0x09, 0x0E)) + b" "
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Odd multipliers, one per place in a shingle.
_MIX = np.random.default_rng(5).integers(1, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_STIR = np.uint64(0x9E3779B97F4A7C15)


def text_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered."""
    return text.encode().translate(_LOWER).split()


def stir(x: np.ndarray) -> np.ndarray:
    """A fixed bijection on 64-bit numbers that spreads low bits."""
    x = (x ^ (x >> np.uint64(31))) * _STIR
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, remembered: int = 200_000):
        super().__init__()
        self.remembered = remembered

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < self.remembered and len(word) <= 48:
            self[word] = value
        return value


def hashes(words: list[bytes], table: WordHashes) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """A hash for each run of ``width`` words; a shorter text is one shingle, an empty one has none."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += words[i : i + n] * _MIX[i]
    return stir(total)


def word_table() -> WordHashes:
    """Hashes that a worker keeps between tasks."""
    return held("word hashes", WordHashes)
