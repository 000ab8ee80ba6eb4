"""Maximal repeats by an enhanced suffix array: suffixes in order, common prefixes of neighbours, and their intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64


def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), np.int64)
    new[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, order


def suffix_array(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``data[offsets[k]:offsets[k + 1]]`` in the order of their first ``depth`` bytes, with the common prefix of each and the one before it.

    Built by doubling; common prefixes never cross the end of a string.
    """
    n = len(data)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(_U)
    word = np.zeros(n, _U)
    for k in range(8):
        byte = np.where(left > k, padded[k : n + k], _U(0))
        word |= byte << _U(8 * (7 - k))
    rank, _ = _ranks(word)
    rank, order = _ranks(rank * 9 + np.minimum(left, 8))
    levels = [(8, rank)]
    size = 8
    while size < depth:
        after = np.zeros(n, np.int64)
        more = np.flatnonzero(left > size)
        after[more] = rank[more + size] + 1
        rank, order = _ranks(rank * (n + 1) + after)
        size *= 2
        levels.append((size, rank))
    common = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for size, rank in reversed(levels):
        room = np.minimum(left[np.minimum(a, n - 1)], left[np.minimum(b, n - 1)])
        same = (a < n) & (b < n) & (room >= size)
        same[same] = rank[a[same]] == rank[b[same]]
        # a suffix that ends exactly here has nothing more in common
        step = np.where(same, size, 0)
        common[1:] += step
        ended = same & (room == size)
        a, b = np.where(ended, n, a + step), np.where(ended, n, b + step)
    rest = (a < n) & (b < n)
    x = word[a[rest]] ^ word[b[rest]]
    room = np.minimum(left[a[rest]], left[b[rest]])
    equal = np.zeros(len(x), np.int64)
    for k in range(1, 8):
        equal[(x >> _U(64 - 8 * k)) == 0] = k
    common[1:][rest] += np.minimum(equal, room)
    return order, common


def intervals(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last) of at least ``least``, children before parents, by one scan with a stack."""
    at = np.flatnonzero(common >= least)
    if not len(at):
        return
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1, True])
    lengths = common.tolist()
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        first, last = int(at[low]) - 1, int(at[high - 1])
        stack = [(least - 1, first)]
        for k in range(first + 1, last + 2):
            value = lengths[k] if k <= last else least - 1
            start = k - 1
            while value < stack[-1][0]:
                length, start = stack.pop()
                yield length, start, k - 1
            if value > stack[-1][0]:
                stack.append((value, start))


def maximal_repeats(data: np.ndarray, offsets: np.ndarray, least: int, depth: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, all places) of every string of at least ``least`` bytes found twice or more that no longer string contains at all places.

    An interval of the enhanced suffix array cannot be extended to the right; it cannot be extended to the left where
    the bytes before its suffixes differ, or one of them begins its string.
    """
    if len(data) < least:
        return
    order, common = suffix_array(data, offsets, depth)
    before = np.where(order > 0, data[np.maximum(order - 1, 0)].astype(np.int64), 0)
    begins = np.isin(order, offsets)
    before[begins] = 256 + order[begins]
    change = np.flatnonzero(np.r_[before[1:] != before[:-1], True])
    same_until = change[np.searchsorted(change, np.arange(len(order)))]
    # where neighbours with a long common prefix all follow the same byte, none of their intervals counts
    long = common >= least
    block = np.cumsum(~long)
    diverse = np.zeros(int(block[-1]) + 1, bool)
    differs = np.r_[False, before[1:] != before[:-1]] & long
    diverse[block[differs]] = True
    for length, first, last in intervals(np.where(diverse[block] & long, common, 0), least):
        if same_until[first] < last:
            yield length, order[first : last + 1]
