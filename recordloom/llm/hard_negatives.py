"""Hard negatives by Kronecker-packed products: exact integer scores of several candidates from one multiplication.

Components are whole numbers. The components of several candidates, each raised by a bias so that none is negative, lie
in separate fields of one wide integer; anchors are raised likewise. One product an anchor component, summed over the
components, then holds the scores of all those candidates side by side: a field is wide enough for the largest possible
sum, so none runs into its neighbour. Where two fields or more fit the 53 bits that a double holds exactly, the words
are doubles and the products one matrix multiplication; where they do not, they are Python integers of any width. Both
are exact.

Anchors are a set of queries that grows with the table, so they go through in blocks of a bounded size. A block is sent to
all tasks, each task keeps the best few of its rows for each anchor, and these are merged by a window. Positives come from
a first pass over all rows, negatives within the bounds that each positive sets from a second one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.tables import scratch_path, written

#: Bytes of the components of the anchors of a block.
BLOCK_BYTES = 1 << 22
#: Scores held at once by a task.
TILE = 1 << 20
#: Rows of a task, where there are more than cores ask for.
TASK_ROWS = 100_000
#: Candidates looked at together.
CANDIDATES = 4096
_EXACT_BITS = 53
_LONG = (-(1 << 63), (1 << 63) - 1)
_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_BEST = "anchor int, slot int, score long, vec_id long"


def scaled(vector: Column) -> Column:
    """``floor(256 * x)`` of each component, as a double; null where the vector or any component is null or not finite, or too large for it."""
    parts = F.transform(vector, lambda x: F.lit(256.0) * x.cast("double"))
    usable = ~F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # a double of more than 53 bits is whole already
    return F.when(vector.isNotNull() & usable, F.transform(parts, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)))


class Packing:
    """Fields for candidates whose components, like the anchors', lie in ``[low, high]``, in ``dims`` dimensions."""

    def __init__(self, low: int, high: int, dims: int) -> None:
        self.low, self.dims = low, dims
        self.width = max(1, (max(1, dims) * (high - low) ** 2).bit_length())
        # a double holds the fields of a word; a wider field goes into Python integers, a few hundred bits a word
        self.fields = _EXACT_BITS // self.width
        self.exact = self.fields == 0
        if self.exact:
            self.fields = max(1, 512 // self.width)

    def matrix(self, rows: list[list[float]]) -> np.ndarray:
        """Components as whole numbers, short vectors filled with zeros: (rows, dims)."""
        if not self.exact:
            out = np.zeros((len(rows), self.dims))
            for at, row in enumerate(rows):
                out[at, : len(row)] = row
            return out
        filled = [[int(x) for x in row] + [0] * (self.dims - len(row)) for row in rows]
        out = np.empty((len(rows), self.dims), object)
        out[:] = filled
        return out

    def of_column(self, column: pa.Array) -> np.ndarray:
        lengths = column.value_lengths().to_numpy()
        if self.exact or (lengths != self.dims).any():
            return self.matrix(column.to_pylist())
        return column.flatten().to_numpy().reshape(-1, self.dims)

    def packed(self, candidates: np.ndarray) -> np.ndarray:
        """(dims, words): field ``f`` of word ``w`` holds the raised components of candidate ``f * words + w``."""
        words = -(-len(candidates) // self.fields)
        raised = np.zeros((words * self.fields, self.dims), candidates.dtype)
        raised[: len(candidates)] = candidates - self.low
        fields = raised.reshape(self.fields, words, self.dims)
        out = fields[-1]
        for field in fields[-2::-1]:
            out = out * (1 << self.width) + field
        return out.T

    def scores(self, anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Inner products, (anchors, candidates), worked out exactly; one beyond 64 bits becomes the nearest 64-bit number."""
        sums_a, sums_c = anchors.sum(axis=1), candidates.sum(axis=1)
        product = (anchors - self.low) @ self.packed(candidates)
        if not self.exact:
            product, sums_a, sums_c = product.astype(np.int64), sums_a.astype(np.int64), sums_c.astype(np.int64)
        parts, mask = [], (1 << self.width) - 1
        for _ in range(self.fields):
            parts.append(product & mask)
            product = product >> self.width
        raised = np.concatenate(parts, axis=1)[:, : len(candidates)]
        # sum (a - low)(c - low) = sum ac - low * (sum a + sum c) + dims * low^2
        scores = raised + self.low * (sums_a[:, None] + sums_c[None, :]) - self.dims * self.low * self.low
        return np.clip(scores, *_LONG).astype(np.int64) if self.exact else scores


def best_of(keys: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` greatest keys of each row, the greatest first; keys are distinct in a row."""
    k = min(k, keys.shape[1])
    if not k:
        return np.zeros((len(keys), 0), np.int64)
    top = np.argpartition(keys, keys.shape[1] - k, axis=1)[:, keys.shape[1] - k :]
    order = np.argsort(np.take_along_axis(keys, top, 1), axis=1)[:, ::-1]
    return np.take_along_axis(top, order, 1)


class _Best:
    """The best ``k`` (score, id) of each row of a block so far: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.held: list[list[tuple]] = [[] for _ in range(n)]

    def add(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores of candidates sorted by id, for the rows from ``first`` on."""
        n = scores.shape[1]
        wide = scores.size and max(int(scores.max()), -int(scores.min())) >= 1 << 48  # then a key of score and place needs more than 64 bits
        keys = (scores.astype(object) if wide else scores) * n + np.arange(n - 1, -1, -1)
        keys[~allowed] = -(1 << 100) if wide else -(1 << 62)
        top = best_of(keys, self.k)
        good = np.take_along_axis(allowed, top, 1)
        for row in np.flatnonzero(good.any(axis=1)).tolist():
            new = [(-int(scores[row, c]), int(ids[c])) for c in top[row][good[row]].tolist()]
            self.held[first + row] = sorted(self.held[first + row] + new)[: self.k]


def _candidates(batches: Iterator[pa.RecordBatch], packing: Packing) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CANDIDATES):
            part = batch.slice(at, CANDIDATES)
            part = part.take(pc.sort_indices(part.column("vec_id")))
            yield part.column("vec_id").to_numpy(), part.column("label").to_numpy(), packing.of_column(part.column("parts"))


def _pass(rows: DataFrame, n_rows: int, packing: Packing, block: list, bounds: list[tuple[int, int, int, int, int]], k: int, same_label: bool) -> DataFrame:
    """The best ``k`` rows of each task for every entry of ``bounds``: (anchor, slot, its place in the block, least, greatest score).

    Entries are in order of their place. Scores are of rows with the anchor's label and another id, or of rows with another label.
    """
    sent = rows.sparkSession.sparkContext.broadcast((block, bounds))  # bounded by BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, wanted = sent.value
        vectors = packing.matrix([a["parts"] for a in anchors])
        ids, labels = (np.array([a[c] for a in anchors], np.int64) for c in ("vec_id", "label"))
        places = np.array([b[2] for b in wanted])
        least, greatest = (np.array([min(max(b[c], _LONG[0]), _LONG[1]) for b in wanted], np.int64) for c in (3, 4))
        best = _Best(len(wanted), k)
        for c_ids, c_labels, candidates in _candidates(batches, packing):
            step = max(1, TILE // max(1, len(c_ids)))
            for first in range(0, len(wanted), step):
                at = places[first : first + step]
                own, row = np.unique(at, return_inverse=True)
                scores = packing.scores(vectors[own], candidates)[row]
                if same_label:
                    allowed = (labels[at][:, None] == c_labels) & (ids[at][:, None] != c_ids)
                else:
                    low, high = least[first : first + step], greatest[first : first + step]
                    allowed = (labels[at][:, None] != c_labels) & (scores >= low[:, None]) & (scores <= high[:, None])
                best.add(first, scores, allowed, c_ids)
        found = [(w[0], w[1], -s, v) for w, held in zip(wanted, best.held) for s, v in held]
        columns = list(zip(*found)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))], ["anchor", "slot", "score", "vec_id"])

    # every task returns a few rows an anchor, so there are no more tasks than cores or their size ask for
    tasks = rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, n_rows // TASK_ROWS))
    merged = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return tasks.mapInArrow(run, _BEST).withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k)


def usable_rows(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", label: Column | None = None) -> DataFrame:
    """(vec_id, label, parts) of the rows that take part: a known id and label, and a vector of finite components."""
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label_column}`").cast("long").alias("own"), scaled(F.col(f"`{vector_column}`")).alias("parts"),
    ).where("vec_id IS NOT NULL AND own IS NOT NULL AND parts IS NOT NULL")
    return rows.select("vec_id", (F.col("own") if label is None else label).cast("long").alias("label"), "parts")


def mine(rows: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``rows`` come from ``usable_rows``; ``anchors`` is a condition on them. An anchor's positives are its first rows of the
    same label and another id, higher scores first, ties by smaller id. For each positive the first rows of other labels
    whose score is between ``least_percent`` and ``most_percent`` of the positive's are returned, ranked from 1. Scores
    are exact whole numbers; a vector shorter than others counts as filled with zeros. Rows equal in id, label and
    vector are one anchor, but as positives or negatives they are rows each. A score beyond 64 bits counts as the
    nearest 64-bit number. A table without anchors or without rows gives an empty result.
    """
    rows = written(rows, "vectors")
    spark = rows.sparkSession
    shape = rows.agg(F.max(F.size("parts")).alias("dims"), F.min(F.array_min("parts")).alias("low"), F.max(F.array_max("parts")).alias("high"), F.count(F.lit(1)).alias("n")).first()
    dims = max(1, shape["dims"] or 1)
    packing = Packing(min(0, int(shape["low"] or 0)), max(0, int(shape["high"] or 0)), dims)
    per_block = max(1, BLOCK_BYTES // (8 * dims))
    queries = rows.where(anchors).groupBy("vec_id", "label", "parts").agg(F.count(F.lit(1)).alias("n"))
    n_anchors = queries.count()
    n_blocks = max(1, -(-n_anchors // per_block))
    # dealt by hash, a block has about per_block anchors; cut again below, it never has more
    dealt = written(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "parts"), F.lit(n_blocks)).cast("int")), "anchors")
    path = None
    for number in range(n_blocks if n_anchors else 0):
        held: list = []
        for row in dealt.where(F.col("block") == number).orderBy("vec_id", "label", "parts").toLocalIterator():
            held.append({c: row[c] for c in ("vec_id", "label", "parts")})
            if len(held) == per_block:
                path = _block(rows, shape["n"], packing, held, (positives, negatives), (least_percent, most_percent), path)
                held = []
        if held:
            path = _block(rows, shape["n"], packing, held, (positives, negatives), (least_percent, most_percent), path)
    return spark.read.schema(_MINED).parquet(path) if path else spark.createDataFrame([], _MINED)


def _block(rows: DataFrame, n_rows: int, packing: Packing, block: list, counts: tuple[int, int], percent: tuple[int, int], path: str | None) -> str:
    """Hard negatives of the anchors of one block, appended to scratch storage."""
    every = [(at, 0, at, *_LONG) for at in range(len(block))]
    found = written(_pass(rows, n_rows, packing, block, every, counts[0], True), "positives")
    bounds, chosen = [], []
    for row in found.orderBy("anchor", "rank").collect():  # at most ``counts[0]`` rows an anchor of the block
        score = row["score"]
        bounds.append((row["anchor"], row["rank"], row["anchor"], -((-percent[0] * score) // 100), (percent[1] * score) // 100))
        chosen.append((row["anchor"], row["rank"], block[row["anchor"]]["vec_id"], row["vec_id"], score))
    picked = rows.sparkSession.createDataFrame(chosen, "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
    hard = _pass(rows, n_rows, packing, block, bounds, counts[1], False)
    out = hard.join(F.broadcast(picked), ["anchor", "slot"]).select(  # as bounded as the block
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
    path = path or scratch_path(rows.sparkSession, "negatives")
    out.write.mode("append").parquet(path)
    return path
