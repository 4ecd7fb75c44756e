"""Hashed character n-grams of many words at once."""

from __future__ import annotations

import numpy as np

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint64)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, a line end before and after each, and the word number at each place."""
    codes = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return codes, np.cumsum(codes == 10) - 1


def hashed_grams(codes: np.ndarray, numbers: np.ndarray, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word number of each n-gram; word ends count as characters. Words hold no line ends."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, inside = np.full(n, size, np.uint64), np.ones(n, bool)
    for k in range(size):
        own = codes[k:n + k]
        h = (h ^ own) * _FACTORS[k % len(_FACTORS)]
        h ^= h >> np.uint64(15)
        if 0 < k < size - 1:
            inside &= own != 10
    if size == 2:
        inside &= ~((codes[:n] == 10) & (codes[1:n + 1] == 10))
    at = np.flatnonzero(inside)
    return ((h[at] ^ (h[at] >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64), numbers[at]
