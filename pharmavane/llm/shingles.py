"""Word shingles of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import hashlib
import re

import numpy as np

WORDS = re.compile(rb"[^ \t-\r]+")
WIDTH = 5  # words of a shingle
REMEMBERED = 1 << 18
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # odd, of the published splitmix64


class WordHashes(dict):
    """64-bit hashes of the words met so far; never more than ``REMEMBERED``."""

    def __missing__(self, word: bytes) -> int:
        found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 32:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


def scramble(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text, ascending; a short text is one shingle.

    A-Z count as a-z. The hash of a shingle is built word by word, so it depends on
    their order and, for short texts, on their number.
    """
    words = WORDS.findall(text.lower())  # of bytes: A-Z alone
    if not words:
        return np.empty(0, np.uint64)
    of_word = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(WIDTH, len(words))
    state = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        state = scramble(state ^ of_word[k : k + len(state)])
    state.sort()
    keep = np.empty(len(state), bool)
    keep[0] = True
    np.not_equal(state[1:], state[:-1], out=keep[1:])
    return state[keep]


def fingerprint(found: np.ndarray) -> int:
    """One signed 64-bit number for a set: equal sets, equal numbers."""
    return int(np.add.reduce(scramble(found), dtype=np.uint64) ^ scramble(np.array([len(found)], np.uint64))[0]) - (1 << 63)
