"""Hashes of all windows of byte buffers, and of words, in numpy."""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Positions that are hashed at a time, so that the arrays stay in cache.
STRIDE = 1 << 17


def _constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit numbers by splitmix64, the same everywhere."""
    with np.errstate(over="ignore"):
        z = (np.arange(1, n + 1, dtype=_U) + _U(seed)) * _U(0x9E3779B97F4A7C15)
        z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return (z ^ (z >> _U(31))) | _U(1)


BYTES = _constants(1, 256)
FACTORS = _constants(2, 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each number spread over all of it."""
    x = (x ^ (x >> _U(31))) * FACTORS[40]
    return x ^ (x >> _U(29))


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of data[i:i + size] for each i at which that is whole."""
    n = len(data) - size + 1
    out = np.empty(max(n, 0), dtype=_U)
    for at in range(0, n, STRIDE):
        h = BYTES[data[at:at + STRIDE + size - 1]]
        have, level = 1, 0
        while 2 * have <= size:
            h = h[:-have] * FACTORS[level] + h[have:]
            h ^= h >> _U(29)
            have, level = 2 * have, level + 1
        if have < size:
            h = h[:have - size] * FACTORS[level] + h[size - have:]
        h = mixed(h)
        out[at:at + len(h)] = h
    return out


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """min(x[i:i + size]) for each i at which that is whole."""
    n = len(x) - size + 1
    out = np.empty(max(n, 0), dtype=x.dtype)
    for at in range(0, n, STRIDE):
        m = x[at:at + STRIDE + size - 1]
        have = 1
        while 2 * have <= size:
            m = np.minimum(m[:-have], m[have:])
            have *= 2
        if have < size:
            m = np.minimum(m[:have - size], m[size - have:])
        out[at:at + len(m)] = m
    return out
