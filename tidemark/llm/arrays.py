"""Hashes of word sequences in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_CACHED_WORDS = 400_000


class WordHashes(dict):
    """64-bit hash of each word seen; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, 0)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs of hashes."""
    x = a * _A + b * _B
    x ^= x >> np.uint64(29)
    x *= _C
    x ^= x >> np.uint64(32)
    return x


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` word hashes, by doubling."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, at, out = h, 1, 0, None
    while True:
        if length & size:
            part = power[at : at + n]
            out = part if out is None else mixed(out, part)
            at += size
        if size * 2 > length:
            return out
        power = mixed(power[:-size], power[size:])
        size *= 2


def rightmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the last smallest value in each window of ``width`` values."""
    best, size = np.arange(len(values)), 1

    def better(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[right] <= values[left], right, left)

    while size * 2 <= width:
        best = better(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = better(best[: len(best) - (width - size)], best[width - size :])
    return best


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return values.astype(np.uint64, copy=False).view(np.int64)
