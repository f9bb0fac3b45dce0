"""Words of a text, as bytes and as hashes."""

from __future__ import annotations

import string

import numpy as np
import xxhash

#: Lower-cases A-Z and turns ASCII punctuation into blanks.
PLAIN = bytes(
    32 if chr(i) in string.punctuation else i + 32 if 65 <= i <= 90 else i for i in range(256)
)


def lower_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
    return text.lower().split()


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.translate(PLAIN).split()


class WordHashes:
    """64-bit hashes of words, the same in every process; hashes of common words are remembered."""

    def __init__(self, limit: int = 200_000) -> None:
        self.limit = limit
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        except KeyError:
            pass
        if len(known) > self.limit:
            known.clear()
        digest = xxhash.xxh3_64_intdigest
        for word in words:
            if word not in known:
                known[word] = digest(word)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words: a polynomial of the word hashes (Karp-Rabin)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    out = words[:n].copy()
    for k in range(1, size):
        out *= base
        out += words[k : k + n]
    return out
