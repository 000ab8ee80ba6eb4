"""A quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins, and each term of the model is a lookup table over the bins of one feature, or of two.
Training goes round the terms again and again; each time a shallow tree fitted to what is still unexplained is added to
the term's table, scaled down. A text's score is then a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import words
from recordloom.llm.labelled import held_out, training_rows
from recordloom.llm.quality_rules import measure
from recordloom.llm.tables import by_batches

#: Labelled rows that a model is fitted to, at most.
TRAINING_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
RATE = 0.15
#: Rows that a leaf needs, in units of the loss's curvature.
LEAF_WEIGHT = 2.0

FEATURES = (
    "log_words", "word_length", "symbols", "repeated_lines", "repeated_words", "capitals", "echoes", "distinct_words",
    "line_words", "digits", "punctuation", "other_alphabet", "long_words", "commonest",
)


def features(texts: words.Texts) -> np.ndarray:
    """A row for each text, a column for each of ``FEATURES``; all are 0 for an empty text."""
    data, n = texts.data, len(texts)
    m = {k: v.astype(float) for k, v in measure(texts).items()}
    found = words.words(texts, lower=True)
    count = np.maximum(m["n_words"], 1)
    size = np.maximum(np.diff(texts.offsets).astype(float), 1)
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[texts.offsets])
    owner = np.repeat(np.arange(n), found.counts)
    order = np.lexsort((found.hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (owner[order][1:] != owner[order][:-1]) | (found.hashes[order][1:] != found.hashes[order][:-1])
    starts = np.flatnonzero(new)
    times = np.diff(np.r_[starts, len(order)])
    most = np.zeros(n)
    np.maximum.at(most, owner[order][starts], times)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    return np.stack(
        [
            np.log1p(m["n_words"]), m["word_chars"] / count, m["n_symbols"] / np.maximum(m["word_chars"], 1),
            m["n_dup_lines"] / np.maximum(m["n_lines"], 1), m["n_repeat_words"] / count, m["n_upper"] / np.maximum(m["n_letters"], 1),
            m["n_echoes"] / count, np.bincount(owner[order][starts], minlength=n) / count, m["n_words"] / np.maximum(m["n_lines"], 1),
            per_text(digit) / size, per_text(~(letter | digit | blank)) / size, per_text(data >= 128) / size,
            np.bincount(owner[found.ends - found.starts > 15], minlength=n) / count, most / count,
        ],
        axis=1,
    )


@dataclass
class Term:
    columns: tuple[int, ...]
    cuts: list[np.ndarray]
    table: np.ndarray

    def cells(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for c, cuts in zip(self.columns, self.cuts):
            out = out * (len(cuts) + 1) + np.searchsorted(cuts, x[:, c], "right")
        return out


@dataclass
class AdditiveModel:
    base: float
    terms: list[Term]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for term in self.terms:
            total += term.table.ravel()[term.cells(x)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Of the cuts of a row of bins: the gain of the best one, and the bins on its left."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(g.sum(), h.sum())
    gain[(left_h < LEAF_WEIGHT) | (right_h < LEAF_WEIGHT)] = -np.inf
    if not len(gain):
        return -np.inf, 0
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """The values of a shallow tree over bins (one or two axes), each leaf's being a Newton step."""
    best = (0.0, -1, 0)
    if depth:
        for axis in range(g.ndim):
            others = tuple(k for k in range(g.ndim) if k != axis)
            gain, k = _best_cut(g.sum(axis=others), h.sum(axis=others))
            best = max(best, (gain, axis, k))
    if best[1] < 0:
        return np.full(g.shape, g.sum() / (h.sum() + 1.0))
    halves = [np.split(x, [best[2]], axis=best[1]) for x in (g, h)]
    return np.concatenate([_tree(a, b, depth - 1) for a, b in zip(*halves)], axis=best[1])


def _boost(terms: list[Term], cells: list[np.ndarray], total: np.ndarray, y: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        for term, cell in zip(terms, cells):
            p = 1 / (1 + np.exp(-total))
            size = term.table.size
            g = np.bincount(cell, y - p, size).reshape(term.table.shape)
            h = np.bincount(cell, p * (1 - p), size).reshape(term.table.shape)
            step = RATE * _tree(g, h, 2)
            term.table += step
            total = np.clip(total + step.ravel()[cell], -20, 20)
    return total


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Main terms first, then the pairs of features that explain most of the rest; constant with one class only."""
    if not len(y) or y.min() == y.max():
        return AdditiveModel(0.0 if not len(y) else (4.0 if y[0] else -4.0), [])
    base = float(np.log(y.mean() / (1 - y.mean())))
    mains = []
    for c in range(x.shape[1]):
        cuts = _cuts(x[:, c], BINS)
        mains.append(Term((c,), [cuts], np.zeros(len(cuts) + 1)))
    total = _boost(mains, [t.cells(x) for t in mains], np.full(len(y), base), y, ROUNDS)
    p = 1 / (1 + np.exp(-total))
    found = []
    coarse = [_cuts(x[:, c], PAIR_BINS) for c in range(x.shape[1])]
    for a in range(x.shape[1]):
        for b in range(a):
            term = Term((b, a), [coarse[b], coarse[a]], np.zeros((len(coarse[b]) + 1, len(coarse[a]) + 1)))
            cell = term.cells(x)
            g = np.bincount(cell, y - p, term.table.size).reshape(term.table.shape)
            h = np.bincount(cell, p * (1 - p), term.table.size).reshape(term.table.shape)
            step = _tree(g, h, 2)
            found.append((float((step * g).sum() - 0.5 * (step * step * h).sum()), -len(found), term, cell))
    found.sort(key=lambda f: f[:2], reverse=True)
    pairs = [f[2] for f in found[:PAIRS]]
    _boost(pairs, [f[3] for f in found[:PAIRS]], total, y, ROUNDS // 4)
    return AdditiveModel(base, mains + pairs)


def _text_features(rows: DataFrame, others: list[str]) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.slices(batch.column("text")):
                x = features(texts)
                kept = [batch.column(c).slice(texts.first, len(texts)) for c in others]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(list(x), pa.list_(pa.float64()))], [*others, "x"])

    return by_batches(rows, run, ", ".join(f"`{c}` {types[c]}" for c in others) + ", x array<double>")


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", limit: int = TRAINING_ROWS, **names: str) -> AdditiveModel:
    """A model of ``label`` fitted to at most ``limit`` labelled rows that are not held out; only their features come to the driver."""
    sample = _text_features(training_rows(docs, labels, [label], limit, **names), [label]).toPandas()
    x = np.array(sample["x"].tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)  # the fit does not depend on how rows were dealt
    return fit(x[order], sample[label].to_numpy(float)[order])


def score(docs: DataFrame, model: AdditiveModel, *, threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` between 0 and 1 and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored; null and empty ones get the score of a text whose features are all 0.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, len(texts)), pa.array(model.scores(features(texts)))], ["id", "score"])

    scored = by_batches(rows, run, f"id {id_type}, score double")
    return scored.select(
        F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
