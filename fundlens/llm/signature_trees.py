"""Joins within groups by signature trees.

An item is a set with its size, the bits that its tokens set in a bitmap, and a
label. Eight neighbours make a node, eight nodes the next: a node holds the
OR of the bitmaps, the range of sizes, the most tokens that share a bit with
another of their set, and the label if all have the same. Two trees, or one with itself,
are traversed together from their roots: a pair of nodes is dropped if its size
ranges are too far apart, if all of both carry one label, or if the largest
overlap that the bitmaps allow is too small; else its children are paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

FAN_OUT = 8
#: Pairs of nodes that are looked at together.
AT_ONCE = 1 << 14


@dataclass
class Level:
    bits: np.ndarray  # rows of 64-bit numbers
    least: np.ndarray
    most: np.ndarray
    shared: np.ndarray  # most tokens of a set beyond its number of bits
    label: np.ndarray  # -1: different ones


def items(bits: np.ndarray, size: np.ndarray, label: np.ndarray) -> Level:
    return Level(bits, size, size, size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64), label)


def _above(low: Level) -> Level:
    at = np.arange(0, len(low.least), FAN_OUT)
    first, last = np.minimum.reduceat(low.label, at), np.maximum.reduceat(low.label, at)
    return Level(np.bitwise_or.reduceat(low.bits, at, axis=0), np.minimum.reduceat(low.least, at),
                 np.maximum.reduceat(low.most, at), np.maximum.reduceat(low.shared, at),
                 np.where(first == last, first, -1))


def possible(x: Level, i: np.ndarray, y: Level, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether some set of x[i] and some of y[j] may have a similarity of ``percent``.

    Sets of a and b tokens need an overlap of percent (a + b) / (100 + percent). Tokens that both
    have set bits that both have; further common tokens share a bit in either set.
    """
    fits = (100 * x.most[i] >= percent * y.least[j]) & (100 * y.most[j] >= percent * x.least[i])
    fits &= (x.label[i] != y.label[j]) | (x.label[i] == -1)
    out = np.flatnonzero(fits)
    a, b = i[out], j[out]
    common = np.bitwise_count(x.bits[a] & y.bits[b]).sum(axis=1, dtype=np.int64)
    overlap = common + np.minimum(x.shared[a], y.shared[b])
    fits[out] = (100 + percent) * overlap >= percent * (x.least[a] + y.least[b])
    return fits


def join(level: Level, percent: int, split: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of items that may be similar and have different labels, in blocks.

    With ``split``, only pairs of an item before that place with one from it on.
    """
    n = len(level.least)
    if split is not None:
        left = Level(*(getattr(level, f)[:split] for f in Level.__dataclass_fields__))
        right = Level(*(getattr(level, f)[split:] for f in Level.__dataclass_fields__))
    else:
        left = right = level
    xs, ys = [left], [right]
    while max(len(xs[-1].least), len(ys[-1].least)) > FAN_OUT:
        xs.append(_above(xs[-1]))
        ys.append(_above(ys[-1]) if split is not None else xs[-1])
    if not n or not len(left.least) or not len(right.least):
        return
    i, j = (a.ravel() for a in np.indices((len(xs[-1].least), len(ys[-1].least))))
    stack = [(len(xs) - 1, i, j)]
    steps = np.arange(FAN_OUT)
    while stack:
        depth, i, j = stack.pop()
        if len(i) > AT_ONCE:
            stack += [(depth, i[k:k + AT_ONCE], j[k:k + AT_ONCE]) for k in range(0, len(i), AT_ONCE)]
            continue
        if split is None:
            ordered = i <= j if depth else i < j
            i, j = i[ordered], j[ordered]
        fits = possible(xs[depth], i, ys[depth], j, percent)
        i, j = i[fits], j[fits]
        if not len(i):
            continue
        if not depth:
            yield i, (j if split is None else j + split)
            continue
        i = (i[:, None, None] * FAN_OUT + steps[None, :, None] + 0 * steps[None, None, :]).ravel()
        j = (j[:, None, None] * FAN_OUT + steps[None, None, :] + 0 * steps[None, :, None]).ravel()
        there = (i < len(xs[depth - 1].least)) & (j < len(ys[depth - 1].least))
        stack.append((depth - 1, i[there], j[there]))
