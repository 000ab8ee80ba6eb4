"""Benchmark passages in documents, by counting shared q-grams in diagonal bands and verifying by banded alignment.

Each benchmark item is cut into overlapping segments. A place in a text where a segment occurs with at most ``EDITS``
edits shares at least ``length - Q + 1 - Q * EDITS`` q-grams with it (each edit destroys ``Q`` at most), all within a
band of diagonals as wide as the edits and a stretch of text little longer than the segment. So: mark the text's
q-grams that any item has; keep dense stretches; count hits by item and overlapping band of diagonals; keep regions with
enough of them; align those regions with their segments inside the band. Items too short for that are looked for as
whole words, without edits.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import words
from recordloom.llm.tables import by_batches

Q = 8
#: Bytes of a segment, after folding case and white space; a shorter item is one segment.
SEGMENT = 64
#: From one segment of an item to the next.
STRIDE = 16
#: Edits allowed in a segment; a shorter item is allowed its share.
EDITS = 4
#: Items of less than this many bytes have too few q-grams to be counted; they are looked for as whole words without edits.
SHORTEST = 24
#: Bytes of benchmark text that one pass looks for; a larger benchmark takes more passes.
BLOCK_BYTES = 4 << 20
#: Bits of the first test of a q-gram.
_TEST_BITS = 24
#: The same for short items, for each length.
_SHORT_BITS = 18
_U = np.uint64
_MULTIPLY = _U(0x9E3779B97F4A7C15)


def folded(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in lower case with each run of white space as one blank, as bytes and offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lower = pc.utf8_lower(column.fill_null("").cast(pa.large_string()))
    data, offsets = words.utf8(lower)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    data = np.where(space, np.uint8(32), data)
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], at[offsets]


def q_grams(data: np.ndarray) -> np.ndarray:
    """The ``Q`` bytes from each place as a number."""
    if len(data) < Q:
        return np.zeros(0, _U)
    return np.ndarray((len(data) - Q + 1,), "<u8", np.ascontiguousarray(data), strides=(1,))


def _shape(data: np.ndarray) -> np.ndarray:
    """Of each byte, whether it is an ASCII letter, digit or underscore."""
    return ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | ((data >= 48) & (data <= 57)) | (data == 95)


def _joins(left: str, right: str) -> bool:
    """Whether two characters side by side belong to one word; in scripts without blanks between words none do."""

    def part(c: str) -> bool:
        return c == "_" or c.isalnum() or unicodedata.category(c)[0] == "M"

    def alone(c: str) -> bool:
        k = ord(c)
        return 0xE00 <= k < 0xF00 or 0x1000 <= k < 0x10A0 or 0x1780 <= k < 0x1800 or 0x2E80 <= k < 0xD7B0 or 0xF900 <= k < 0xFB00 or 0xFF66 <= k < 0xFFA0 or k >= 0x20000

    return part(left) and part(right) and not alone(left) and not alone(right)


def _character(data: np.ndarray, at: int, step: int) -> str:
    """The character of UTF-8 that begins (``step`` 1) or ends (-1) at a byte."""
    first = at
    while step < 0 and data[first] & 0xC0 == 0x80:
        first -= 1
    return data[first : first + 4].tobytes().decode("utf-8", "ignore")[0]


def _ends_a_word(data: np.ndarray, at: int) -> bool:
    """Whether no word goes on from the byte before ``at`` to the one there."""
    return not _joins(_character(data, at - 1, -1), _character(data, at, 1))


@dataclass
class ShortItems:
    """Items of less than ``SHORTEST`` bytes without the blanks around them, by length: the three q-grams that cover
    each text, a hash of these in order, and the items that have this text."""

    by_length: dict[int, tuple[np.ndarray, np.ndarray, list[list[int]], np.ndarray]]

    @staticmethod
    def _covers(gram: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        if length <= Q:
            whole = gram[at] & _U((1 << 8 * length) - 1)
            return np.stack([whole, whole, whole])
        return np.stack([gram[at], gram[at + min(Q, length - Q)], gram[at + length - Q]])

    @staticmethod
    def _hash(cover: np.ndarray) -> np.ndarray:
        return words.mix(cover[0] + words.mix(cover[1] + words.mix(cover[2])))

    @classmethod
    def of(cls, texts: dict[int, bytes]) -> ShortItems:
        lengths: dict[int, dict[bytes, list[int]]] = {}
        for k, text in texts.items():
            if text.strip():
                lengths.setdefault(len(text.strip()), {}).setdefault(text.strip(), []).append(k)
        out = {}
        for length, own in lengths.items():
            data = np.frombuffer(b"".join(x + bytes(Q) for x in own), np.uint8)
            cover = cls._covers(q_grams(data), np.arange(len(own)) * (length + Q), length)
            order = np.argsort(cls._hash(cover), kind="stable")
            items = list(own.values())
            hashed = cls._hash(cover)[order]
            test = np.zeros(1 << _SHORT_BITS, bool)
            test[hashed >> _U(64 - _SHORT_BITS)] = True
            out[length] = (hashed, cover[:, order], [items[k] for k in order.tolist()], test)
        return cls(out)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) for documents that hold an item's text and no word goes on beyond it."""
        out: set[tuple[int, int]] = set()
        for at in range(0, len(data), words.PIECE) if self.by_length else ():
            gram = q_grams(np.concatenate([data[at : at + words.PIECE + SHORTEST], np.zeros(SHORTEST + Q, np.uint8)]))
            around = np.concatenate([data[max(0, at - 1) : at], np.zeros(int(at == 0), np.uint8), data[at : at + words.PIECE + SHORTEST], np.zeros(1, np.uint8)])
            inner = _shape(around)
            inner = inner[1:] & inner[:-1]  # of each place, whether an ASCII word goes on into it
            edge = np.zeros(len(inner), bool)
            edge[offsets[(offsets >= at) & (offsets < at + len(inner))] - at] = True
            begins = np.flatnonzero((~inner | edge)[: min(words.PIECE, len(data) - at)])
            for length, (hashed, cover, items, test) in self.by_length.items():
                place = begins[begins + length <= len(data) - at]
                place = place[~inner[place + length] | edge[place + length]]
                own = self._covers(gram, place, length)
                mixed = self._hash(own)
                likely = test[mixed >> _U(64 - _SHORT_BITS)]
                place, own, mixed = place[likely], own[:, likely], mixed[likely]
                known = np.minimum(np.searchsorted(hashed, mixed), len(hashed) - 1)
                same = (cover[:, known] == own).all(axis=0)
                place, known = place[same] + at, known[same]
                of = np.searchsorted(offsets, place, "right") - 1
                low, high = offsets[of], offsets[of + 1]
                fits = place + length <= high
                for p, k, d, a, b in zip(*(x[fits].tolist() for x in (place, known, of, low, high))):
                    if (d, items[k][0]) not in out and (p == a or _ends_a_word(data, p)) and (p + length == b or _ends_a_word(data, p + length)):
                        out.update((d, item) for item in items[k])
        return out


@dataclass
class Index:
    """Items of one block: their bytes, where their q-grams are, and a bitmap of these."""

    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    test: np.ndarray
    short: ShortItems

    @classmethod
    def of(cls, ids: list[int], texts: list[str | None]) -> Index:
        data, offsets = folded(pa.array(texts, pa.string()))
        item, place, short = [], [], {}
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if b - a >= SHORTEST:
                place.append(np.arange(b - a - Q + 1))
                item.append(np.full(b - a - Q + 1, k))
            else:
                short[k] = data[a:b].tobytes()
        item_ = np.concatenate(item) if item else np.zeros(0, np.int64)
        place_ = np.concatenate(place) if place else np.zeros(0, np.int64)
        gram = q_grams(data)[offsets[item_] + place_] if len(item_) else np.zeros(0, _U)
        order = np.argsort(gram, kind="stable")
        grams, first = np.unique(gram[order], return_index=True)
        test = np.zeros(1 << _TEST_BITS, bool)
        test[(grams * _MULTIPLY) >> _U(64 - _TEST_BITS)] = True
        return cls(np.array(ids, np.int64), data, offsets, grams, np.append(first, len(gram)), item_[order], place_[order], test, ShortItems.of(short))

    def segments(self, item: int) -> list[tuple[int, int, int]]:
        """(start, length, edits) of an item's segments; the last one ends with the item."""
        size = int(self.offsets[item + 1] - self.offsets[item])
        if size <= SEGMENT:
            return [(0, size, size * EDITS // SEGMENT)]
        starts = [*range(0, size - SEGMENT, STRIDE), size - SEGMENT]
        return [(s, SEGMENT, EDITS) for s in starts]


def least_hits(length: int, edits: int) -> int:
    """The q-gram lemma."""
    return length - Q + 1 - Q * edits


def aligned(pattern: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> bool:
    """Whether ``pattern`` is found in ``text`` with at most ``edits`` edits on diagonals (text minus pattern) in the band.

    Dynamic programming over the band only; the match may begin and end anywhere in the text.
    """
    diagonals = np.arange(low - edits, high + edits + 1)
    row = np.where((diagonals >= 0) & (diagonals <= len(text)), 0, edits + 1)
    step = np.arange(len(diagonals))
    padded = np.concatenate([text, np.zeros(1, text.dtype)])
    for k, byte in enumerate(pattern.tolist()):
        at = diagonals + k  # text before this place is matched with pattern[:k]
        inside = (at >= 0) & (at < len(text))
        over = np.where(inside, row + (padded[np.clip(at, 0, len(text))] != byte), edits + 1)
        down = np.append(row[1:], edits + 1) + 1  # the pattern's byte left out
        row = np.minimum(over, np.where((at + 1 >= 0) & (at + 1 <= len(text)), down, edits + 1))
        row = np.minimum.accumulate(row - step) + step  # the text's bytes left out
        row = np.minimum(row, edits + 1)
        if row.min() > edits:
            return False
    return bool(row.min() <= edits)


def matches(data: np.ndarray, offsets: np.ndarray, index: Index) -> list[tuple[int, int]]:
    """(document, item) for documents that hold a segment of an item or a short item; ``data`` holds folded texts one after the other."""
    return sorted({*_segment_matches(data, offsets, index), *index.short.matches(data, offsets)})


def _segment_matches(data: np.ndarray, offsets: np.ndarray, index: Index) -> list[tuple[int, int]]:
    if len(data) < Q or not len(index.grams):
        return []
    needed = min(least_hits(n, e) for k in range(len(index.ids)) if index.offsets[k + 1] - index.offsets[k] >= SHORTEST for _, n, e in index.segments(k))
    reach = SEGMENT + EDITS - Q + 1  # places of q-grams of one occurrence
    dense: list[np.ndarray] = []
    for at in range(0, len(data) - Q + 1, words.PIECE):
        low, high = max(0, at - reach), min(len(data), at + words.PIECE + reach + Q)
        gram = q_grams(data[low:high])
        hit = index.test[(gram * _MULTIPLY) >> _U(64 - _TEST_BITS)]
        # a place counts if some stretch around it has enough marked places
        total = np.concatenate([[0], np.cumsum(hit, dtype=np.int32)])
        width = min(reach, len(hit))
        full = np.flatnonzero(total[width:] - total[:-width] >= min(needed, width))
        cover = np.zeros(len(hit) + 1, np.int32)
        np.add.at(cover, full, 1)
        np.add.at(cover, full + width, -1)
        place = np.flatnonzero(hit & (np.cumsum(cover[:-1]) > 0)) + low
        dense.append(place[(place >= at) & (place < at + words.PIECE)])
    place = np.concatenate(dense)
    gram = q_grams(data)[place]
    known = np.minimum(np.searchsorted(index.grams, gram), len(index.grams) - 1)
    exact = index.grams[known] == gram
    place, known = place[exact], known[exact]
    of = np.searchsorted(offsets, place, "right") - 1
    whole = place + Q <= offsets[of + 1]
    place, known, of = place[whole], known[whole], of[whole]
    if not len(place):
        return []
    out: set[tuple[int, int]] = set()
    count = index.first[known + 1] - index.first[known]
    for low, high in _portions(count):
        n = count[low:high]
        entry = np.repeat(index.first[known[low:high]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        out |= _regions(np.repeat(place[low:high], n), np.repeat(of[low:high], n), index.item[entry], index.place[entry], data, offsets, index, needed, out)
    return sorted(out)


def _portions(count: np.ndarray, size: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Stretches of places with about ``size`` hits, overlapping so that no occurrence is cut."""
    total = np.cumsum(count)
    reach = SEGMENT + EDITS
    low = 0
    while low < len(count):
        before = total[low - 1] if low else 0
        high = max(int(np.searchsorted(total, before + size, "right")), low + 4 * reach)
        high = min(high, len(count))
        yield low, high
        if high == len(count):
            return
        low = high - 2 * reach


def _regions(place: np.ndarray, of: np.ndarray, item: np.ndarray, where: np.ndarray, data: np.ndarray, offsets: np.ndarray, index: Index, needed: int, known: set[tuple[int, int]]) -> set[tuple[int, int]]:
    """Hits counted by document, item and band of diagonals; regions with enough of them, verified."""
    at = place - offsets[of]
    diagonal = at - where + (1 << 20)
    width = EDITS + 1
    # bands overlap: of width 2 * width at steps of width, so any EDITS + 1 neighbouring diagonals lie in one
    band = np.concatenate([diagonal // width, diagonal // width - 1])
    of, item, at, where = (np.concatenate([x, x]) for x in (of, item, at, where))
    order = np.lexsort((at, band, item, of))
    of, item, band, at, where = of[order], item[order], band[order], at[order], where[order]
    group = np.cumsum(np.r_[0, (of[1:] != of[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])])
    # a place may hit twice in a band; places are counted once
    new = np.r_[True, (group[1:] != group[:-1]) | (at[1:] != at[:-1])]
    of, item, band, at, where, group = of[new], item[new], band[new], at[new], where[new], group[new]
    if len(at) < needed:
        return set()
    ahead = np.arange(len(at) - needed + 1)
    enough = np.flatnonzero((group[ahead + needed - 1] == group[ahead]) & (at[ahead + needed - 1] - at[ahead] <= SEGMENT + EDITS - Q))
    found: set[tuple[int, int]] = set()
    tried: set[tuple[int, int, int]] = set()
    for k in enough.tolist():
        pair = (int(of[k]), int(item[k]))
        if pair in found or pair in known:
            continue
        first = offsets[pair[0]]
        low = int(band[k]) * width - (1 << 20)
        span = range(int(where[k]), int(where[k + needed - 1]) + Q)
        for start, length, edits in index.segments(pair[1]):
            if start + length < span.start or start > span.stop or (k // needed, start, int(band[k])) in tried:
                continue
            tried.add((k // needed, start, int(band[k])))
            a = max(0, start + low - 2 * EDITS)
            text = data[first + a : min(first + start + length + low + 2 * width + 2 * EDITS, offsets[pair[0] + 1])]
            pattern = index.data[index.offsets[pair[1]] + start : index.offsets[pair[1]] + start + length]
            if aligned(pattern, text, start + low - a, start + low - a + 2 * width - 1, edits):
                found.add(pair)
                break
    return found


def benchmark_blocks(benchmark: DataFrame, *, id_column: str = "item_id", text_column: str = "text") -> list[list[tuple[Any, str]]]:
    """The benchmark in blocks of about ``BLOCK_BYTES``; one block is sent to the tasks at a time."""
    blocks: list[list[tuple[Any, str]]] = [[]]
    size = 0
    for row in benchmark.select(id_column, text_column).where(F.col(text_column).isNotNull() & F.col(id_column).isNotNull()).distinct().toLocalIterator():
        if size > BLOCK_BYTES:
            blocks.append([])
            size = 0
        blocks[-1].append((row[0], row[1]))
        size += len(row[1])
    return blocks


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_items``, ``item_ids`` (sorted) and ``contaminated``.

    A document is contaminated by an item if it holds one of the item's segments of ``SEGMENT`` bytes within ``EDITS``
    edits, case and white space apart; an item shorter than a segment must be there as a whole, one shorter than
    ``SHORTEST`` bytes as whole words and without edits. Null and empty texts hold nothing; items that are null or
    blank are held by nothing. Item ids may be of any type; equal ids are one item, whatever texts they have. ``carry`` adds the row itself as ``row``. Each block of the benchmark is a pass over the documents, and results are united by rows.
    """
    item = benchmark.schema["item_id"].dataType.simpleString()
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []), F.array().cast(f"array<{item}>").alias("item_ids"),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    for block in benchmark_blocks(benchmark):
        rows = by_batches(rows, _search(block), schema)
    sorted_ids = F.array_sort(F.array_distinct("item_ids"))
    return rows.select(
        F.col("id").alias(id_column), F.size(sorted_ids).cast("long").alias("n_items"), sorted_ids.alias("item_ids"), (F.size("item_ids") > 0).alias("contaminated"),
        *(["row"] if carry else []),
    )


def _search(block: list[tuple[Any, str]]):  # type: ignore[no-untyped-def]
    """Adds the block's items that a row's text holds to its ``item_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.of(list(range(len(block))), [t for _, t in block])
        for batch in batches:
            texts = batch.column("text")
            found = batch.column("item_ids").to_pylist()
            size = np.cumsum(pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64)) if len(texts) else np.zeros(0, np.int64)
            first = 0
            while first < len(texts):
                last = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + words.SLICE, "right")))
                data, offsets = folded(texts.slice(first, last - first))
                for k, item in matches(data, offsets, index):
                    found[first + k].append(block[int(index.ids[item])][0])
                first = last
            place = batch.schema.get_field_index("item_ids")
            yield batch.set_column(place, batch.schema.field(place), pa.array(found, batch.schema.field(place).type))

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with all their columns."""
    found = contamination(docs, benchmark, carry=True, **names)
    return found.where(~F.col("contaminated")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
