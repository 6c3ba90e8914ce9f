"""Distinct word n-grams of whole texts as sorted 64-bit hashes, in numpy over UTF-8 bytes.

Words are runs of bytes other than space and \\x09 to \\x0D, with A-Z in lower case. The order of
the hashes is the global order of n-grams: the same everywhere and unrelated to any text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text that are worked on at once: their arrays fit into a processor's cache.
PIECE_BYTES = 1 << 20

_white = np.zeros(256, bool)
_white[[32, *range(9, 14)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_bytes = np.random.default_rng(97).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the power of 0, 1, ... n - 1; those that a usual piece needs are kept."""
    return _kept_powers(int(base))[:n] if n <= PIECE_BYTES + 1 else _powers(base, n)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


@lru_cache(4)
def _kept_powers(base: int) -> np.ndarray:
    return _powers(np.uint64(base), PIECE_BYTES + 1)


def distinct(grams: np.ndarray) -> np.ndarray:
    """Sorted without repeats; a plain sort is faster here than numpy's hashed unique."""
    grams = np.sort(grams)
    return grams[np.concatenate([[True], grams[1:] != grams[:-1]])]


def word_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the text it belongs to; starts: where each text begins in raw."""
    white = _white[raw]
    before = np.ones(len(raw), bool)
    before[1:] = white[:-1]
    before[starts[starts < len(raw)]] = True
    after = np.ones(len(raw), bool)
    after[:-1] = white[1:]
    inner = starts[(starts > 0) & (starts < len(raw))]
    after[inner - 1] = True
    first, last = np.flatnonzero(before & ~white), np.flatnonzero(after & ~white)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_bytes[_lower[raw]] * powers(BASE, len(raw)), dtype=np.uint64)])
    words = (sums[last + 1] - sums[first]) * powers(INVERSE, len(raw) + 1)[first]
    return mix(words + (last - first).astype(np.uint64)), np.searchsorted(starts, first, "right") - 1


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about PIECE_BYTES; a longer text stands alone."""
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, "right")) - 1)
        yield i, j
        i = j


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct hashes of width successive words.

    A text with fewer words has its whole sequence as its one n-gram; a text without words has none.
    """
    for i, j in _pieces(offsets):
        words, owner = word_hashes(raw[offsets[i] : offsets[j]], offsets[i:j] - offsets[i])
        counts = np.bincount(owner, minlength=j - i)
        grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            grams = mix(grams * np.uint64(31) + words[k : k + len(grams)])
        at = np.concatenate([[0], np.cumsum(counts)])
        for d in range(j - i):
            n = at[d + 1] - at[d]
            if n >= width:
                yield distinct(grams[at[d] : at[d + 1] - width + 1])
            elif n:
                yield whole_sequence(words[at[d] : at[d + 1]])
            else:
                yield np.zeros(0, np.uint64)


def whole_sequence(words: np.ndarray) -> np.ndarray:
    """The one n-gram of a text that is shorter than an n-gram."""
    gram = np.full(1, len(words), np.uint64)
    for word in words:
        gram = mix(gram * np.uint64(31) + word)
    return gram


def digest(grams: np.ndarray) -> tuple[int, int]:
    """A name of a set: 128 bits, as two signed words."""
    mixed = mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    named = mix(np.array([np.add.reduce(mixed) + np.uint64(len(grams)), np.bitwise_xor.reduce(mixed)], np.uint64)).view(np.int64)
    return int(named[0]), int(named[1])
