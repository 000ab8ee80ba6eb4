"""Token counts of texts by byte-level BPE, merged rank by rank on ragged arrays.

A slice of texts is cut into pre-tokens by the classes of its characters. Its distinct new pre-tokens are held in one
flat array of symbols with the lengths of its sequences. In every round each sequence finds its lowest-ranked pair and
merges all its occurrences from left to right, all sequences at once; sequences without a pair that can merge leave.
What is left of a sequence are its tokens. Counts of pre-tokens are remembered by hash in each task, within a bound.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import words
from recordloom.llm.tables import by_batches

#: Pre-tokens remembered by a task; beyond it the memory is started anew.
REMEMBERED = 1_000_000
_NONE = np.iinfo(np.int64).max
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Of every code point: letter, number, white space or other."""
    points = [chr(k) if not 0xD800 <= k < 0xE000 else "!" for k in range(0x110000)]
    every = "".join(points)
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, every):
            out[found.start() : found.end()] = kind
    return out


def byte_classes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 belongs to."""
    classes = _classes()
    out = classes[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int64)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        point = first & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            point[more] = point[more] << 6 | data[lead[more] + k] & 0x3F
        kind = classes[np.minimum(point, 0x10FFFF)]
        for k in range(4):
            more = size > k
            out[lead[more] + k] = kind[more]
    return out


def pre_tokens(data: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, in texts ``data[parts[k]:parts[k + 1]]`` one after the other.

    A pre-token is a run of letters, of numbers or of other characters, each with one blank before it if there is one;
    an apostrophe alone with s, t, re, ve, m, ll or d after it; or the rest of a run of white space, whose last
    character stands alone if it is not a blank and something follows.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = byte_classes(data)
    cut = np.zeros(n + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[parts] = True
    last = np.zeros(n + 1, bool)
    last[parts] = True
    runs = np.flatnonzero(cut)
    starts, ends = runs[:-1], runs[1:]
    of = kind[starts]
    begin = np.zeros(n + 1, bool)
    begin[starts] = True
    # white space with something behind it in the same text: its last character goes its own way
    space = (of == _SPACE) & ~last[ends]
    tail = ends[space] - 1
    while (inner := (data[tail] & 0xC0) == 0x80).any():
        tail = tail - inner
    begin[tail] = True
    blank = data[tail] == 32
    begin[ends[space][blank]] = False
    # an apostrophe alone, not joined to a blank, before letters
    one = np.flatnonzero((of == _OTHER) & (ends - starts == 1) & (data[starts] == 39) & ~last[ends] & begin[starts])
    if len(one):
        one = one[kind[ends[one]] == _LETTER]
        at, room = ends[one], ends[one + 1] - ends[one]
        a, b = data[at], data[np.minimum(at + 1, n - 1)]
        two = (room > 1) & ((b == ord("e")) & ((a == ord("r")) | (a == ord("v"))) | (a == ord("l")) & (b == ord("l")))
        short = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        length = np.where(short, 1, np.where(two, 2, 0))
        begin[at[length > 0]] = False
        begin[(at + length)[length > 0]] = True
    begin[n] = False
    return np.flatnonzero(begin)


def _byte_characters() -> dict[str, int]:
    """The characters by which the format writes bytes: printable Latin-1 as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class RankedMerges:
    """The vocabulary of a byte-level BPE file: symbols are ids, pairs are ``left * size + right``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("a byte-level BPE file without normaliser is needed")
        vocabulary: dict[str, int] = model["vocab"]
        self.size = max(vocabulary.values()) + 1
        self.of_byte = np.full(256, -1, np.int64)
        for character, byte in _byte_characters().items():
            self.of_byte[byte] = vocabulary[character]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        special.sort(key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, special))) if special else None
        self.forget()

    def forget(self) -> None:
        self.known, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """How many symbols are left of each sequence of bytes; ``data`` holds them one after the other."""
        left_over = lengths.copy()
        active = np.flatnonzero(lengths > 1)
        symbols = self.of_byte[data][np.repeat(lengths > 1, lengths)]
        lengths = lengths[active]
        rank = np.full(len(symbols), _NONE)
        rank[:-1] = self._ranks(symbols[:-1], symbols[1:])
        rank[np.cumsum(lengths) - 1] = _NONE  # no pair across sequences
        while len(active):
            lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
            owner = np.repeat(np.arange(len(active)), lengths)
            # of overlapping occurrences (a run of one symbol) every second one merges, from the left
            at = np.flatnonzero((rank == lowest[owner]) & (rank != _NONE))
            run = np.ones(len(at), bool)
            run[1:] = at[1:] != at[:-1] + 1
            first = at[run][np.cumsum(run) - 1] if len(at) else at
            at = at[(at - first) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[np.maximum(at - 1, 0)] = True
            lengths = lengths - np.bincount(owner[at], minlength=len(active))
            left_over[active] = lengths
            more = (lowest != _NONE) & (lengths > 1)
            keep &= more[owner]
            symbols, changed, rank = symbols[keep], np.flatnonzero(changed[keep]), rank[keep]
            lengths, active = lengths[more], active[more]
            if len(active):
                right = symbols[np.minimum(changed + 1, len(symbols) - 1)]
                rank[changed] = self._ranks(symbols[changed], right)
                rank[np.cumsum(lengths) - 1] = _NONE
        return left_over

    def count(self, texts: words.Texts) -> np.ndarray:
        """Tokens of each text; the file's special strings inside a text are one token each."""
        data, cuts, extra = texts.data, texts.offsets, np.zeros(len(texts), np.int64)
        found = [m.span() for m in self.special.finditer(data)] if self.special else []
        if found:
            at = np.array(found, np.int64)
            owner = np.searchsorted(texts.offsets, at[:, 0], "right") - 1
            inside = at[:, 1] <= texts.offsets[owner + 1]
            at, owner = at[inside], owner[inside]
            extra = np.bincount(owner, minlength=len(texts))
            cuts = np.unique(np.concatenate([cuts, at.ravel()]))
        starts = pre_tokens(data, cuts)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        if found:
            plain = ~np.isin(starts, _within(starts, at))
            starts, ends = starts[plain], ends[plain]
        value, where, inverse = np.unique(words.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.forget()
        place = np.searchsorted(self.known, value)
        old = np.zeros(len(value), bool)
        fits = place < len(self.known)
        old[fits] = self.known[place[fits]] == value[fits]
        n = np.zeros(len(value), np.int64)
        n[old] = self.counts[place[old]]
        new = where[~old]
        if len(new):
            lengths = ends[new] - starts[new]
            at = np.repeat(starts[new] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
            n[~old] = self.merge(data[at], lengths)
            self.known = np.insert(self.known, place[~old], value[~old])
            self.counts = np.insert(self.counts, place[~old], n[~old])
        total = np.concatenate([[0], np.cumsum(n[inverse])])
        first = np.searchsorted(starts, texts.offsets)
        return total[first[1:]] - total[first[:-1]] + extra


def _within(starts: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Those of ``starts`` that lie in one of the spans, which are apart and in order."""
    k = np.searchsorted(spans[:, 0], starts, "right") - 1
    return starts[(k >= 0) & (starts < spans[np.maximum(k, 0), 1])]


@lru_cache(maxsize=2)
def _merges(path: str) -> RankedMerges:
    return RankedMerges(path)


def count_tokens(
    docs: DataFrame, vocabulary: str, *, id_column: str = "doc_id", text_column: str = "text", limit: int = 1024
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``).

    ``vocabulary`` is the place of a byte-level BPE file; every executor gets a copy of it. Texts are counted whole,
    without begin or end tokens. A null or empty text has 0 bytes and tokens. Repeated rows are counted each; other
    columns are not read. Token counts do not depend on how the rows are dealt.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(vocabulary)
    name = vocabulary.replace("\\", "/").rsplit("/", 1)[-1]
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(SparkFiles.get(name))
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for texts in words.slices(column):
                tokens = merges.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(texts.first, len(texts)),
                        pa.array(np.diff(texts.offsets), pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array(tokens > limit),
                    ],
                    ["id", "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    counted = by_batches(rows, run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", id_column)
