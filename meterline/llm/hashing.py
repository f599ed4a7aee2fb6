"""Vectorized hashes of words, word windows and byte windows."""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer that spreads every input bit (in place)."""
    x ^= x >> _S
    x *= _M1
    x ^= x >> _S
    x *= _M2
    x ^= x >> _S
    return x


def odd_numbers(n: int, seed: int, dtype=np.uint64) -> np.ndarray:
    """Fixed pseudo-random odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)).astype(dtype) | dtype(1)


class WordHashes(dict):
    """64-bit hash of each word, kept for the words met so far; starts anew when full."""

    def __init__(self, limit: int = 1_000_000) -> None:
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_windows(hashes: np.ndarray, width: int, seed: int = 7) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes; empty if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(odd_numbers(width, seed)):
        out += hashes[j:j + n] * factor
    return mix(out)


def byte_windows(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` bytes, by doubling; empty if there are fewer."""
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = odd_numbers(64, 11)
    part = mix(data.astype(np.uint64) + np.uint64(1))
    out, done, span, step = None, 0, 1, 0
    while True:
        if width & span:  # take this power of two behind what is done
            piece = part[done:done + n]
            out = piece.copy() if out is None else out * factors[step + 32] + piece
            done += span
        if done == width:
            return mix(out)
        part = part[:-span] * factors[step] + part[span:]
        part ^= part >> np.uint64(29)
        span, step = span * 2, step + 1


def leftmost_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Position of the least hash, the leftmost of equal ones, in each run of ``width``.

    Depends on the run's content alone, so equal runs choose the same place.
    Hashes are compared by their upper 36 bits, positions take the other 28.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    if len(hashes) >> 28:
        raise ValueError("a text must stay below 256 MB")
    place = np.uint64((1 << 28) - 1)
    least = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return (np.minimum(least[:n], least[width - span:width - span + n]) & place).astype(np.int64)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of equal values."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edges = np.flatnonzero(values[1:] != values[:-1])
    return np.concatenate([[0], edges + 1]), np.concatenate([edges, [len(values) - 1]])
