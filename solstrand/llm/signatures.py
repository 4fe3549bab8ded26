"""Signature trees over sets of hashes.

A leaf is one set: a bitmap of its elements and its size.  A node has the OR of its children's
bitmaps and the range of their sizes.  Two nodes are compared by the most that sets below them can
share; pairs of nodes that cannot reach the similarity are dropped with all that lies below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np

LEAST_BITS = 512
FANOUT = 8
# Node pairs looked at together: bounds the memory of a traversal, not its result.
FRONTIER = 1 << 16


def width(size: int) -> int:
    """Bits of a set's bitmap: the power of two from twice its size up, so at most half are set."""
    return max(LEAST_BITS, 1 << max(2 * size - 1, 1).bit_length())


def signature(elements: np.ndarray) -> np.ndarray:
    bits = width(len(elements))
    flags = np.zeros(bits, np.uint8)
    flags[(elements & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def folded(bitmap: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap of the same set with fewer bits."""
    while len(bitmap) * 64 > bits:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] | bitmap[half:]
    return bitmap


class Level(NamedTuple):
    bits: np.ndarray  # rows x words
    fewest: np.ndarray  # set bits of the set that has fewest
    least: np.ndarray
    most: np.ndarray


def build(bits: np.ndarray, sizes: np.ndarray) -> list[Level]:
    """Levels from the leaves up to one root; neighbours in the given order share a parent."""
    levels = [Level(bits, np.bitwise_count(bits).sum(1, dtype=np.int64), sizes, sizes)]
    while len(levels[-1].least) > 1:
        low = levels[-1]
        at = np.arange(0, len(low.least), FANOUT)
        levels.append(
            Level(
                np.bitwise_or.reduceat(low.bits, at, axis=0),
                np.minimum.reduceat(low.fewest, at),
                np.minimum.reduceat(low.least, at),
                np.maximum.reduceat(low.most, at),
            )
        )
    return levels


def _may_link(level: Level, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets x below a and y below b can have den * intersection >= num * union.

    x has at least `fewest` bits, of which those outside both bitmaps stand for elements that y
    lacks: at least miss_a of them, and likewise miss_b of y.  So the intersection is at most
    |x| - miss_a and the union at least |x| + miss_b, which is loosest for the largest x.
    """
    least_a, most_a, least_b, most_b = level.least[a], level.most[a], level.least[b], level.most[b]
    # The similarity of sizes x <= y is at most x / y.
    ok = (den * most_a >= num * least_b) & (den * most_b >= num * least_a)
    if not ok.any():
        return ok
    both = np.bitwise_count(level.bits[a] & level.bits[b]).sum(1, dtype=np.int64)
    miss_a = np.maximum(level.fewest[a] - both, 0)
    miss_b = np.maximum(level.fewest[b] - both, 0)
    if level.least is level.most:  # leaves: the sizes are known
        shared = np.minimum(least_a - miss_a, least_b - miss_b)
        return ok & (den * shared >= num * (least_a + least_b - shared))
    ok &= den * (most_a - miss_a) >= num * (most_a + miss_b)
    return ok & (den * (most_b - miss_b) >= num * (most_b + miss_a))


def linked_leaves(
    levels: list[Level], num: int, den: int, grouping: Callable[[], np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves (a < b) that may be similar, from a dual traversal of the tree with itself.

    They come in batches, the most similar bitmaps of a batch first.  `grouping` gives the current
    group of each leaf: node pairs whose leaves are all of one group are not opened.
    """
    top = len(levels) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        depth, a, b = stack.pop()
        if grouping is not None:
            groups = grouping()
            at = np.arange(0, len(groups), FANOUT**depth)
            low, high = np.minimum.reduceat(groups, at), np.maximum.reduceat(groups, at)
            open_ = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
            a, b = a[open_], b[open_]
        if not len(a):
            continue
        if depth == 0:
            apart = a < b
            a, b = a[apart], b[apart]
            ok = _may_link(levels[0], a, b, num, den) if len(a) else np.zeros(0, bool)
            if ok.any():
                a, b = a[ok], b[ok]
                x, y = levels[0].bits[a], levels[0].bits[b]
                alike = np.bitwise_count(x & y).sum(1) / np.maximum(np.bitwise_count(x | y).sum(1), 1)
                best = np.argsort(-alike, kind="stable")
                yield a[best], b[best]
            continue
        ok = (a == b) | _may_link(levels[depth], a, b, num, den)
        a, b = a[ok], b[ok]
        step = max(1, FRONTIER // FANOUT**2)
        for i in reversed(range(0, len(a), step)):
            pa, pb = a[i : i + step], b[i : i + step]
            ca = (pa[:, None] * FANOUT + np.arange(FANOUT)).repeat(FANOUT, 1).ravel()
            cb = np.tile(pb[:, None] * FANOUT + np.arange(FANOUT), (1, FANOUT)).ravel()
            inside = (ca <= cb) & (cb < len(levels[depth - 1].least))
            stack.append((depth - 1, ca[inside], cb[inside]))


def forest(
    pairs: Iterator[tuple[np.ndarray, np.ndarray]], groups: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the pairs, those that join two groups; `groups` is merged as if they all were links."""
    for a, b in pairs:
        kept = []
        rest = np.flatnonzero(groups[a] != groups[b])
        while len(rest):
            i = rest[0]
            kept.append(i)
            x, y = groups[a[i]], groups[b[i]]
            groups[groups == max(x, y)] = min(x, y)
            rest = rest[1:]
            rest = rest[groups[a[rest]] != groups[b[rest]]]
        if kept:
            yield a[kept], b[kept]
