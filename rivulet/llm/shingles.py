"""Words and word shingles of texts as 64-bit hashes, in numpy.

A word is a maximal run of bytes other than space and \\x09-\\x0D, lower-cased
A-Z.  Hashes are the same on every machine and in every run.
"""

from __future__ import annotations

import functools

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_K1, _K2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_TABLE = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 64, 256, dtype=np.uint64)
_EXACT = _TABLE.copy()
_TABLE[65:91] = _TABLE[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x *= _K1
    x ^= x >> np.uint64(33)
    x *= _K2
    x ^= x >> np.uint64(33)
    return x


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and _BASE ** -i modulo 2 ** 64."""
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word in UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash for each word, in order."""
    begin, end = word_spans(data)
    return span_hashes(data, begin, end)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hashes of byte spans [begin, end), A-Z as a-z unless ``fold`` is false."""
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_TABLE if fold else _EXACT)[data] * up[:len(data)], out=total[1:])
    return scramble((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def sequences(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; fewer words make one run, none make none."""
    if len(words) == 0:
        return words
    if len(words) < k:
        k = len(words)
    out = words[:len(words) - k + 1].copy()
    for i in range(1, k):
        out = scramble(out * _K2 + words[i:len(words) - k + 1 + i])
    return out


def shingle_set(text: bytes | memoryview, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text."""
    data = np.frombuffer(text, np.uint8) if len(text) else np.zeros(0, np.uint8)
    return np.unique(sequences(word_hashes(data), k))
