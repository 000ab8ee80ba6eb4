"""Toxicity by a chain of linear classifiers.

Categories are predicted in order. The classifier of each sees the words of a text and the probabilities of the
categories before it. While training, those are out-of-fold predictions: a row's earlier probabilities come from models
that have not seen it, so that later models learn how far earlier ones can be trusted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import words
from recordloom.llm.labelled import training_rows
from recordloom.llm.tables import by_batches, written

#: Labelled rows that a chain is fitted to, at most.
TRAINING_ROWS = 20_000
#: Words and beginnings a model knows: those that tell most about the categories.
VOCABULARY = 2_048
#: Documents that a word must be in, with different texts.
LEAST_DOCUMENTS = 4
#: Bytes of the beginnings of words that count beside whole words, as insults are inflected and compounded.
BEGINNINGS = (4, 5, 6)
FOLDS = 4
STEPS = 200
PENALTY = 0.3
_LETTER = np.zeros(256, bool)
_LETTER[128:] = True
_LETTER[65:91] = True
_LETTER[97:123] = True


def word_sets(texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct words (runs of letters, lower case) and their beginnings, sorted, and where each text's begin."""
    data = words.LOWER[texts.data]
    starts, ends = words.spans(~_LETTER[data], texts.offsets[:-1][texts.offsets[:-1] < len(data)])
    parts = [(starts, words.hash_spans(data, starts, ends))]
    for size in BEGINNINGS:
        long = ends - starts > size
        # a beginning is not the word of the same letters
        parts.append((starts[long], words.mix(words.hash_spans(data, starts[long], starts[long] + size) + np.uint64(size))))
    value = np.concatenate([v for _, v in parts])
    owner = np.searchsorted(texts.offsets, np.concatenate([s for s, _ in parts]), "right") - 1
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[keep], np.searchsorted(owner[keep], np.arange(len(texts) + 1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class Linear:
    """Logistic regression over words that are there or not, and some dense columns."""

    base: float
    weights: np.ndarray
    dense: np.ndarray

    def logits(self, row: np.ndarray, column: np.ndarray, extra: np.ndarray) -> np.ndarray:
        return self.base + np.bincount(row, self.weights[column], len(extra)) + extra @ self.dense

    @classmethod
    def fit(cls, row: np.ndarray, column: np.ndarray, extra: np.ndarray, y: np.ndarray, size: int) -> Linear:
        """Accelerated gradient steps, scaled by column; the penalty holds for all but the base."""
        n = len(y)
        model = cls(float(_logit(np.array([(y.sum() + 0.5) / (n + 1)]))[0]), np.zeros(size), np.zeros(extra.shape[1]))
        scale = 0.25 * np.bincount(column, minlength=size) * 4 + PENALTY
        dense_scale = 0.25 * (extra * extra).sum(0) * 4 + PENALTY
        w, d, base = model.weights.copy(), model.dense.copy(), model.base
        for k in range(STEPS):
            ahead = k / (k + 3)
            v = cls(model.base + ahead * (model.base - base), model.weights + ahead * (model.weights - w), model.dense + ahead * (model.dense - d))
            w, d, base = model.weights, model.dense, model.base
            rest = y - _sigmoid(v.logits(row, column, extra))
            model = cls(
                v.base + rest.sum() / (0.5 * n + 1),
                v.weights + (np.bincount(column, rest[row], size) - PENALTY * v.weights) / scale,
                v.dense + (extra.T @ rest - PENALTY * v.dense) / dense_scale,
            )
        return model


@dataclass
class Chain:
    categories: list[str]
    vocabulary: np.ndarray
    models: list[Linear]

    def entries(self, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of the known words of each text."""
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        if not len(self.vocabulary):
            return owner[:0], owner[:0]
        at = np.minimum(np.searchsorted(self.vocabulary, value), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == value
        return owner[known], at[known]

    def probabilities(self, value: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A row for each text, a column for each category, in the chain's order."""
        row, column = self.entries(value, first)
        extra = np.zeros((len(first) - 1, 0))
        out = []
        for model in self.models:
            z = model.logits(row, column, extra)
            out.append(_sigmoid(z))
            extra = np.column_stack([extra, _logit(out[-1])])
        return np.stack(out, axis=1)


def _vocabulary(owner: np.ndarray, value: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The words with the largest chi-square for any category, sorted."""
    unique, column = np.unique(value, return_inverse=True)
    n, total = len(y), np.bincount(column)
    best = np.zeros(len(unique))
    for k in range(y.shape[1]):
        share = y[:, k].mean()
        inside = np.bincount(column, y[owner, k], len(unique))
        gap = inside - total * share
        best = np.maximum(best, gap * gap * n / np.maximum(total * (n - total) * share * (1 - share), 1e-9))
    best[total < LEAST_DOCUMENTS] = 0
    order = np.lexsort((unique, -best))[:VOCABULARY]
    return np.sort(unique[order[best[order] > 0]])


def fit_chain(value: np.ndarray, first: np.ndarray, y: np.ndarray, fold: np.ndarray, categories: list[str]) -> Chain:
    """A chain for texts given by their word sets, with labels ``y`` (a column each) and a fold for each row."""
    n = len(y)
    owner = np.repeat(np.arange(n), np.diff(first))
    chain = Chain(categories, _vocabulary(owner, value, y) if n else np.zeros(0, np.uint64), [])
    return _fit(chain, *chain.entries(value, first), y, fold)


def _fit(chain: Chain, row: np.ndarray, column: np.ndarray, y: np.ndarray, fold: np.ndarray) -> Chain:
    """The models of a chain whose vocabulary is known, from the rows and columns of known words."""
    n, size, categories = len(y), len(chain.vocabulary), chain.categories
    extra = np.zeros((n, 0))
    for k in range(len(categories)):
        target = y[:, k].astype(float)
        chain.models.append(Linear.fit(row, column, extra, target, size))
        unseen = np.zeros(n)
        for f in range(FOLDS):
            out, inside = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
            if not len(out):
                continue
            place = np.full(n, -1)
            place[inside] = np.arange(len(inside))
            use = place[row] >= 0
            part = Linear.fit(place[row[use]], column[use], extra[inside], target[inside], size)
            place[:] = -1
            place[out] = np.arange(len(out))
            use = place[row] >= 0
            unseen[out] = _sigmoid(part.logits(place[row[use]], column[use], extra[out]))
        extra = np.column_stack([extra, _logit(unseen)])
    return chain


def corpus_vocabulary(rows: DataFrame, categories: list[str]) -> np.ndarray:
    """The same choice of words, counted by Spark: only the words chosen come to the driver."""
    totals = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in categories]).first()
    n = totals["rows"]
    if not n:
        return np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.slices(batch.column("text")):
                value, first = word_sets(texts)
                owner = np.repeat(np.arange(len(texts)), np.diff(first)) + texts.first
                unique, place = np.unique(value, return_inverse=True)
                inside = [np.bincount(place, np.asarray(batch.column(c))[owner], len(unique)).astype(np.int64) for c in categories]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unique.view(np.int64)), pa.array(np.bincount(place, minlength=len(unique)).astype(np.int64)), *map(pa.array, inside)],
                    ["word", "n", *categories],
                )

    counted = by_batches(rows, run, "word long, n long, " + ", ".join(f"`{c}` long" for c in categories))
    counted = counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", *categories)]).where(F.col("n") >= LEAST_DOCUMENTS)
    best = F.lit(0.0)
    for c in categories:
        share = float(totals[c]) / n
        gap = F.col(c) - F.col("n") * share
        spread = F.greatest(F.col("n") * (n - F.col("n")) * (share * (1 - share)), F.lit(1e-9))
        best = F.greatest(best, gap * gap * n / spread)
    chosen = counted.withColumn("best", best).where("best > 0").orderBy(F.desc("best"), "word").limit(VOCABULARY)
    return np.sort(chosen.select("word").toPandas()["word"].to_numpy(np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, categories: list[str], *, limit: int = TRAINING_ROWS, **names: str) -> Chain:
    """A chain fitted to at most ``limit`` labelled rows; only the places of their known words come to the driver.

    Copies of a text share a fold, and count once, with their largest label.
    """
    rows = training_rows(docs, labels, categories, limit, **names)
    rows = rows.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(*[F.max(c).alias(c) for c in categories])
    rows = written(rows.withColumn("order", F.xxhash64("text")), "training-rows")
    chain = Chain(categories, corpus_vocabulary(rows, categories), [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.slices(batch.column("text")):
                row, column = chain.entries(*word_sets(texts))
                first = np.searchsorted(row, np.arange(len(texts) + 1))
                cut = [column[a:b].astype("<i4").tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                kept = [batch.column(c).slice(texts.first, len(texts)) for c in ("order", *categories)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(cut, pa.binary())], ["order", *categories, "columns"])

    sample = by_batches(rows, run, "order long, " + ", ".join(f"`{c}` int" for c in categories) + ", columns binary").toPandas()
    sample = sample.sort_values("order", ignore_index=True)  # whatever the order of rows
    column = np.frombuffer(b"".join(sample["columns"]), "<i4").astype(np.int64)
    row = np.repeat(np.arange(len(sample)), sample["columns"].map(len).to_numpy(np.int64) // 4) if len(sample) else column
    y = sample[categories].to_numpy(int) if len(sample) else np.zeros((0, len(categories)), int)
    return _fit(chain, row, column, y, sample["order"].to_numpy(np.int64) % FOLDS)


def predict(docs: DataFrame, chain: Chain, *, flag: str | None = None, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``p_<category>`` for each category and, for ``flag``, whether it reaches the threshold.

    Whole texts are read. A null or empty text has no words, so it gets what the chain gives without any.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.slices(batch.column(1)):
                p = chain.probabilities(*word_sets(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, len(texts)), *[pa.array(np.ascontiguousarray(c)) for c in p.T]], ["id", *names])

    out = by_batches(rows, run, f"id {id_type}, " + ", ".join(f"`{n}` double" for n in names)).withColumnRenamed("id", id_column)
    return out.withColumn(flag, F.col(f"p_{flag}") >= threshold) if flag else out
