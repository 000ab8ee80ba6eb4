"""Signature trees over sets of 64-bit tokens, and their dual traversal.

A leaf is a set, or a cluster of sets; it holds a bitmap of tokens and a range of sizes. A node above holds the
combination (OR) of its children's bitmaps and their size range. Two sets below two nodes share at most as many tokens
as the bitmaps share bits, and as many more as a set has tokens beyond its own bits; a pair of nodes for which even
that is too little is dropped with all that lies below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

#: Bits of a bitmap.
BITS = 2048
FANOUT = 8
#: Pairs of nodes handled at once.
CHUNK = 20_000


@dataclass(frozen=True)
class Threshold:
    """Sets are alike when ``100 * |both| >= percent * |either|``."""

    percent: int

    def possible(self, shared: np.ndarray, low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> np.ndarray:
        """Whether sets of sizes in the ranges with at most ``shared`` common tokens can be alike."""
        p = self.percent
        shared = np.minimum(shared, np.minimum(high_a, high_b))
        return ((100 + p) * shared >= p * (low_a + low_b)) & (100 * high_a >= p * low_b) & (100 * high_b >= p * low_a)

    def alike(self, shared: np.ndarray, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        return (100 + self.percent) * shared >= self.percent * (a + b)

    def prefix(self, n: int) -> int:
        """So many first tokens, in any common order, of which two alike sets share one."""
        return n - -(-n * self.percent // 100) + 1


@dataclass
class Nodes:
    """One level of a tree."""

    bits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    beyond: np.ndarray

    def __len__(self) -> int:
        return len(self.low)


def leaves(sets: list[np.ndarray]) -> Nodes:
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    bits = np.zeros((len(sets), BITS // 64), np.uint64)
    for at in range(0, len(sets), 512):  # a byte for each bit, for some sets at once
        part = sets[at : at + 512]
        plain = np.zeros((len(part), BITS), bool)
        plain[np.repeat(np.arange(len(part)), sizes[at : at + 512]), np.concatenate(part) & np.uint64(BITS - 1)] = True
        bits[at : at + 512] = np.packbits(plain, axis=1).view(np.uint64)
    return Nodes(bits, sizes, sizes.copy(), sizes - np.bitwise_count(bits).sum(1, dtype=np.int64))


def combined(nodes: Nodes, starts: np.ndarray) -> Nodes:
    """Each run of nodes as one."""
    return Nodes(
        np.bitwise_or.reduceat(nodes.bits, starts), np.minimum.reduceat(nodes.low, starts),
        np.maximum.reduceat(nodes.high, starts), np.maximum.reduceat(nodes.beyond, starts),
    )


def tree(bottom: Nodes) -> list[Nodes]:
    """Levels from the leaves up."""
    levels = [bottom]
    while len(levels[-1]) > FANOUT:
        levels.append(combined(levels[-1], np.arange(0, len(levels[-1]), FANOUT)))
    return levels


def possible_pairs(a: Nodes, i: np.ndarray, b: Nodes, j: np.ndarray, threshold: Threshold) -> np.ndarray:
    shared = np.bitwise_count(a.bits[i] & b.bits[j]).sum(1, dtype=np.int64) + np.minimum(a.beyond[i], b.beyond[j])
    return threshold.possible(shared, a.low[i], a.high[i], b.low[j], b.high[j])


def _label_levels(labels: np.ndarray, depth: int) -> list[np.ndarray]:
    """The common label below each node of each level, or -1."""
    out = [labels]
    for _ in range(depth - 1):
        starts = np.arange(0, len(out[-1]), FANOUT)
        low, high = np.minimum.reduceat(out[-1], starts), np.maximum.reduceat(out[-1], starts)
        out.append(np.where(low == high, low, -1))
    return out


def self_pairs(levels: list[Nodes], labels: Callable[[], np.ndarray], threshold: Threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves ``i < j`` with different labels that may be alike, some at once.

    ``labels`` is asked again for each portion, so that what has been linked meanwhile is passed over, whole nodes at once.
    """
    top = len(levels) - 1
    i, j = np.triu_indices(len(levels[top]))
    stack = [(top, i, j)]
    while stack:
        level, i, j = stack.pop()
        if len(i) > CHUNK:
            stack += [(level, i[k : k + CHUNK], j[k : k + CHUNK]) for k in range(0, len(i), CHUNK)]
            continue
        of = _label_levels(labels(), level + 1)[level]
        keep = (of[i] < 0) | (of[i] != of[j])
        if not level:
            keep &= i < j
        i, j = i[keep], j[keep]
        keep = possible_pairs(levels[level], i, levels[level], j, threshold)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if not level:
            yield i, j
            continue
        below = len(levels[level - 1])
        step = np.arange(FANOUT)
        a = (i[:, None, None] * FANOUT + step[None, :, None]) + np.zeros(FANOUT, np.int64)
        b = (j[:, None, None] * FANOUT + step[None, None, :]) + np.zeros((FANOUT, 1), np.int64)
        keep = (a < below) & (b < below) & (a <= b)
        stack.append((level - 1, a[keep], b[keep]))


def shared_tokens(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many tokens of the sorted set ``one`` each of the other sorted sets has."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, every), len(one) - 1)
    total = np.concatenate([[0], np.cumsum(one[at] == every)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


#: Sets that are compared with all others first, as most near copies hang on one of them.
LEADERS = 4


def linked_groups(sets: list[np.ndarray], threshold: Threshold) -> np.ndarray:
    """A label for each set (sorted, not empty), equal for sets joined by a chain of alike sets."""
    m = len(sets)
    labels = np.arange(m)
    sizes = np.fromiter(map(len, sets), np.int64, m)

    def join(one: int, others: np.ndarray) -> None:
        others = others[labels[others] != labels[one]]
        if not len(others):
            return
        alike = others[threshold.alike(shared_tokens(sets[one], [sets[k] for k in others]), sizes[one], sizes[others])]
        if len(alike):
            hit = np.isin(labels, np.append(labels[alike], labels[one]))
            labels[hit] = labels[hit].min()

    for leader in range(min(m - 1, LEADERS)):
        rest = np.arange(leader + 1, m)
        join(leader, rest[threshold.possible(sizes[rest], sizes[leader], sizes[leader], sizes[rest], sizes[rest])])
    if m - 1 <= LEADERS or (labels == labels[0]).all():
        return labels
    order = np.lexsort((np.fromiter((s[0] for s in sets), np.uint64, m), sizes))
    levels = tree(leaves([sets[k] for k in order]))
    for i, j in self_pairs(levels, lambda: labels[order], threshold):
        i, j = order[i], order[j]
        for one in np.unique(i):
            join(int(one), j[i == one])
    return labels


def any_link(center: list[np.ndarray], bottom: Nodes, others: list[np.ndarray], threshold: Threshold) -> bool:
    """Whether one of the others is alike to a set of the center, whose leaves are given."""
    own = leaves(others)
    for k, one in enumerate(others):
        rest = np.flatnonzero(possible_pairs(own, np.full(len(center), k), bottom, np.arange(len(center)), threshold))
        if len(rest) and threshold.alike(shared_tokens(one, [center[r] for r in rest]), len(one), bottom.low[rest]).any():
            return True
    return False
