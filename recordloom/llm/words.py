"""Texts of an Arrow batch as flat numpy arrays: words, their hashes and n-grams of them.

Words are the runs of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``). Everything per byte happens in
pieces of ``PIECE`` bytes, so that memory follows the number of words of a slice of documents, not eight times its bytes.
A hash is a polynomial over the bytes modulo 2**64, mixed; two different words or n-grams share one with probability
2**-64 or so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; documents are never cut, a longer one is a slice of its own.
SLICE = 2 << 20
#: Bytes whose 64-bit intermediates live at once.
PIECE = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, _U)
    out[0] = 1
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * _U(pow(base, filled, 1 << 64))
        filled += step
    return out


_POWER = _powers(_BASE, PIECE + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


@dataclass
class Texts:
    """Some documents of a batch: document ``k`` is ``data[offsets[k]:offsets[k + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE) -> Iterator[Texts]:
    """The column's documents, about ``size`` bytes at a time."""
    data, offsets = utf8(column)
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield Texts(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def spans(space: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``space`` is false, cut at ``cuts`` (sorted positions)."""
    edge = np.empty(len(space) + 1, bool)
    edge[0], edge[-1] = True, True
    np.not_equal(space[1:], space[:-1], out=edge[1:-1])
    edge[cuts] = True
    at = np.flatnonzero(edge)
    inside = ~space[at[:-1]] if len(space) else np.zeros(0, bool)
    return at[:-1][inside], at[1:][inside]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``; the spans are sorted and do not overlap."""
    out = np.zeros(len(starts), _U)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        last = max(at + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        s, e = starts[at:last] - low, ends[at:last] - low
        if e[-1] > PIECE:  # one span longer than a piece: hash it piece by piece
            h = _U(0)
            for k in range(low, int(ends[at]), PIECE):
                part = data[k : min(k + PIECE, int(ends[at]))]
                h = mix(np.array([h * _U(_BASE) + ((part.astype(_U) + _U(1)) * _POWER[: len(part)]).sum(dtype=_U)], _U))[0]
            out[at] = h
        else:
            total = np.zeros(int(e[-1]) + 1, _U)
            np.cumsum((data[low : low + int(e[-1])].astype(_U) + _U(1)) * _POWER[: int(e[-1])], out=total[1:])
            out[at:last] = (total[e] - total[s]) * _INVERSE[s]
        at = last
    return mix(out + (ends - starts).astype(_U))


@dataclass
class Words:
    """The words of some documents: word ``i`` is ``data[starts[i]:ends[i]]``; document ``k`` has words ``first[k]:first[k + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(texts: Texts, lower: bool = False) -> Words:
    data = LOWER[texts.data] if lower else texts.data
    starts, ends = spans(_SPACE[data], texts.offsets[:-1][texts.offsets[:-1] < len(data)])
    return Words(starts, ends, np.searchsorted(starts, texts.offsets), hash_spans(data, starts, ends))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` successive items from each position; ``len(hashes) - n + 1`` of them."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, _U)
    for k in range(n):
        out *= _U(_BASE)
        out += hashes[k : k + count]
    return mix(out)


def gram_sets(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each document, sorted, and where each document's begin.

    A document with fewer than ``n`` words, but at least one, has its whole sequence as the only n-gram.
    """
    count = found.counts
    long = np.maximum(count - n + 1, 0)
    every = grams(found.hashes, n)
    owner = np.repeat(np.arange(len(count)), long)
    at = np.repeat(found.first[:-1], long) + np.arange(len(owner)) - np.repeat(np.cumsum(long) - long, long)
    value = every[at] if len(at) else np.zeros(0, _U)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = np.array([mix(grams(found.hashes[found.first[k] : found.first[k + 1]], int(count[k])) + _U(count[k]))[0] for k in short], _U)
        owner, value = np.concatenate([owner, short]), np.concatenate([value, whole])
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    owner, value = owner[order], value[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[keep], value[keep]
    return value, np.searchsorted(owner, np.arange(len(count) + 1))
