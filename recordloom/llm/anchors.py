"""Content-chosen anchors of byte strings: every string of ``LENGTH`` bytes holds one, chosen by its own bytes alone.

Of the ``GRAM``-byte grams in a window of ``LENGTH`` bytes the one with the smallest hash, the leftmost of equals, is the
window's anchor. Equal windows have equal anchors at equal places, so windows need only be compared where the grams of
their anchors are equal. One gram in about 35 is an anchor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from recordloom.llm import words

_U = np.uint64
_BASE = 0xA24BAED4963EE407
_POWER = words._powers(_BASE, words.PIECE + 1)
_INVERSE = words._powers(pow(_BASE, -1, 1 << 64), words.PIECE + 1)


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of ``data[i:i + length]`` for every ``i``."""
    n = len(data) - length + 1
    out = np.empty(max(n, 0), _U)
    step = words.PIECE - length
    for at in range(0, max(n, 0), step):
        part = data[at : min(at + step + length - 1, len(data))]
        total = np.zeros(len(part) + 1, _U)
        np.cumsum((part.astype(_U) + _U(1)) * _POWER[: len(part)], out=total[1:])
        m = len(part) - length + 1
        out[at : at + m] = words.mix((total[length:] - total[:m]) * _INVERSE[:m])
    return out


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``values[i:i + width]`` for every ``i``, by running minima of blocks in both directions."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


@dataclass
class Anchors:
    """Anchor ``k`` is the gram at ``at[k]``, chosen by the windows that start in ``[low[k], high[k]]``."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    gram: np.ndarray


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Anchors:
    """Anchors of all windows inside the documents ``data[offsets[k]:offsets[k + 1]]``."""
    width = length - gram + 1
    parts: list[tuple[np.ndarray, ...]] = []
    step = words.PIECE
    total = len(data)
    begin = 0
    # documents follow each other; windows across two of them are dropped below
    while begin + length <= total:
        end = min(begin + step + length - 1, total)
        hashes = window_hashes(data[begin:end], gram)
        place = np.arange(len(hashes), dtype=_U)
        least = _sliding_minimum((hashes & ~_U(0xFFFFFF)) | place, width)
        chosen = (least & _U(0xFFFFFF)).astype(np.int64)
        start = np.arange(len(chosen)) + begin
        last = np.searchsorted(offsets, start, "right")
        inside = start + length <= offsets[np.minimum(last, len(offsets) - 1)]
        start, chosen = start[inside], chosen[inside]
        if len(start):
            new = np.r_[True, (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)]
            first = np.flatnonzero(new)
            final = np.r_[first[1:] - 1, len(start) - 1]
            parts.append((chosen[first] + begin, start[first], start[final], hashes[chosen[first]]))
        begin += step
    if not parts:
        return Anchors(*[np.zeros(0, np.int64)] * 3, np.zeros(0, _U))
    return Anchors(*[np.concatenate(x) for x in zip(*parts)])
