"""Hashes of words and of five words in a row, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from .rolling import BYTES, FACTORS, mixed

_U = np.uint64
#: Bytes that separate words: space and \x09 to \x0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True


# Powers of an odd number and of its inverse, as far as texts have needed them.
_BASE = int(FACTORS[42])
_POWERS = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 2 * AT_ONCE)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


#: Bytes whose words are hashed at a time (longer texts by themselves); each takes some 30 of arrays.
AT_ONCE = 1 << 19


def word_hashes(texts: Iterable[bytes], spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of all texts in order, and where each text's words begin."""
    words, begins, part, size, at = [], [np.zeros(1, dtype=np.int64)], [], 0, 0

    def done() -> int:
        own, starts = _word_hashes(part, spaces)
        words.append(own)
        begins.append(starts[1:] + at)
        return at + len(own)

    for text in texts:
        if part and size + len(text) > AT_ONCE:
            at = done()
            part, size = [], 0
        part.append(text)
        size += len(text) + 1
    if part:
        at = done()
    return (np.concatenate(words) if words else np.empty(0, dtype=_U)), np.concatenate(begins)


def _word_hashes(texts: list[bytes], spaces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of some texts.

    A word's hash is the sum of its bytes' numbers times powers of a base, with
    exponents from its first byte on: the sum over places in the buffer, times
    the inverse power of the place of its first byte.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    word = ~spaces[data]
    starts = np.flatnonzero(word[1:] > word[:-1]) + 1
    if word[0]:
        starts = np.concatenate([[0], starts])
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins = np.searchsorted(starts, np.concatenate([[0], ends]))
    if not len(starts):
        return np.empty(0, dtype=_U), begins
    up, back = _powers(len(data))
    value = np.where(spaces, _U(0), BYTES)[data]
    value *= up[:len(data)]
    return mixed(np.add.reduceat(value, starts) * back[starts]), begins


def shingle_sets(texts: Iterable[str | None], size: int = 5) -> list[np.ndarray]:
    """The sorted set of hashes of ``size`` words in a row of each text, A-Z lower-cased.

    With fewer words the whole sequence is one element; without words the set is empty.
    """
    words, begins = word_hashes([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
    rows = np.zeros(max(len(words) - size + 1, 0), dtype=_U)
    for n in range(size):
        rows += words[n:n + len(rows)] * FACTORS[n]
    rows = mixed(rows)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rows[a:b - size + 1]))
        elif b > a:
            short = (words[a:b] * FACTORS[:b - a]).sum(dtype=_U) ^ FACTORS[50 + b - a]
            out.append(mixed(np.array([short], dtype=_U)))
        else:
            out.append(np.empty(0, dtype=_U))
    return out
