"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

The documents of a source in a seeded order make one long stream of tokens, cut into blocks of equal tokens. Seats for
blocks go to sources by the highest quotients ``target / (2 * seats + 1)``, shard after shard, so every shard has whole
quotas and every prefix of shards is in proportion. A source's seats take its blocks in a ring from a seeded one on;
having gone round, they start again. What is taken of a document is then the overlap of two intervals: no block is ever
a row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.tables import by_batches, written

#: Tokens of a block. Blocks cost nothing, so they are small: a source misses its target by half a block or so.
BLOCK_TOKENS = 16
#: Rows of a part of a source's stream, about.
ROWS_PER_PART = 8_000
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def capped_targets(sizes: list[int], weights: list[int], share: Fraction, cap: int) -> list[Fraction]:
    """Shares of ``share`` times all sizes by weight; none above ``cap`` times its size, the excess shared again."""
    targets = [Fraction(0)] * len(sizes)
    rest, active = share * sum(sizes), set(range(len(sizes)))
    while active:
        unit = rest / sum(weights[k] for k in active)
        full = {k for k in active if unit * weights[k] > cap * sizes[k]}
        if not full:
            for k in active:
                targets[k] = unit * weights[k]
            break
        for k in full:
            targets[k] = Fraction(cap * sizes[k])
            rest -= targets[k]
        active -= full
    return targets


def apportion(weights: list[Fraction], limits: list[int], seats: int) -> list[int]:
    """``seats`` by highest quotients ``weight / (2 * seats + 1)``, at most ``limits``; ties go to the earlier one.

    All quotients above a bound are given at once, the bound found by bisection; the last ones one by one.
    """
    seats = min(seats, sum(n for n, w in zip(limits, weights) if w > 0))
    given = lambda bound: [min(n, int(w / (2 * bound) + Fraction(1, 2))) if w > 0 else 0 for w, n in zip(weights, limits)]
    low, high = Fraction(0), max(weights, default=Fraction(0)) + 1
    for _ in range(64):
        middle = ((low + high) / 2).limit_denominator(1 << 40) or (low + high) / 2
        if sum(given(middle)) <= seats:
            high = middle
        else:
            low = middle
    out = given(high)
    queue = [(-weights[k] / (2 * out[k] + 1), k) for k in range(len(weights)) if weights[k] > 0 and out[k] < limits[k]]
    heapq.heapify(queue)
    for _ in range(seats - sum(out)):
        _, k = heapq.heappop(queue)
        out[k] += 1
        if out[k] < limits[k]:
            heapq.heappush(queue, (-weights[k] / (2 * out[k] + 1), k))
    return out


def plan(sizes: dict[str | None, int], *, share: Fraction = Fraction(3, 2), cap: int = 2, shards: int = 24, seed: int = 0) -> list[dict]:
    """Targets, blocks and quotas by source: by code point, null last, with ``WEIGHTS`` over and over."""
    names = sorted((k for k in sizes if k is not None)) + [k for k in sizes if k is None]
    own = [sizes[k] for k in names]
    targets = capped_targets(own, [WEIGHTS[k % len(WEIGHTS)] for k in range(len(names))], share, cap)
    blocks = [max(1, round(Fraction(n, BLOCK_TOKENS))) if n else 0 for n in own]
    # a source of less than half a block has one block of its own size, so weights are in blocks
    weights = [t * b / n if n else Fraction(0) for t, b, n in zip(targets, blocks, own)]
    seats = round(sum(weights))
    ends = [apportion(weights, [cap * b for b in blocks], seats * (s + 1) // shards) for s in range(shards)]
    out = []
    for k, name in enumerate(names):
        quota = [e[k] for e in ends]
        out.append({"source": name, "size": own[k], "target": targets[k], "blocks": blocks[k], "quotas": np.diff([0, *quota]).tolist(), "seats": quota[-1], "first": int(np.random.default_rng([seed, k]).integers(blocks[k])) if blocks[k] else 0})
    return out


def _edge(own: dict, block: int) -> int:
    return block * own["size"] // own["blocks"]


def stream_pieces(own: dict, start: int, size: int) -> list[tuple[int, int, int]]:
    """What the mix takes of the tokens ``[start, start + size)`` of a source's stream, as (shard, first, last token of the document).

    The mixed stream of a source begins at its first chosen block and goes round.
    """
    if not size or not own["seats"]:
        return []
    length, begin = own["size"], _edge(own, own["first"])
    at_block = lambda n: n // own["blocks"] * length + (_edge(own, (own["first"] + n) % own["blocks"]) - begin) % length
    edges = [at_block(n) for n in np.cumsum([0, *own["quotas"]]).tolist()]
    taken = edges[-1]
    out = []
    turned = (start - begin) % length
    cuts = [(turned, 0, min(size, length - turned))]
    if turned + size > length:
        cuts.append((0, length - turned, size))
    for at, low, high in cuts:
        for turn in range(0, taken, length):
            a, b = turn + at, min(turn + at + high - low, taken)
            if a < b:
                k = int(np.searchsorted(edges, a, "right")) - 1
                while a < b:
                    stop = min(b, edges[k + 1])
                    if stop > a:
                        out.append((k, low + a - turn - at, low + stop - turn - at))
                    a, k = max(a, stop), k + 1
    return sorted(out)


def stream_offsets(rows: DataFrame, n_rows: int, seed: int) -> DataFrame:
    """``rows`` (``key``, ``doc_id``, ``text_hash``, ``size``, ...) with ``start``, the tokens of its source before it in the seeded order.

    The order is that of a hash, whose upper bits part each source; parts are summed first, then put in order each for
    itself, so a source with a third of all rows is spread, and so are rows of one id with different texts.
    """
    bits = max(0, int(np.ceil(np.log2(max(1, n_rows / ROWS_PER_PART)))))
    order = F.xxhash64(F.col("doc_id"), F.col("text_hash"), F.lit(seed))
    part = F.shiftrightunsigned(order, 64 - bits) if bits else F.lit(0).cast("long")
    ordered = rows.withColumns({"__order": order}).withColumn("__part", part)
    sums = ordered.groupBy("key", "__part").agg(F.sum("size").alias("__n"))
    before = sums.select("key", "__part", (F.sum("__n").over(Window.partitionBy("key").orderBy("__part")) - F.col("__n")).alias("__before"))
    inside = Window.partitionBy("key", "__part").orderBy("__order", "doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ordered.join(before, ["key", "__part"])
        .withColumn("start", F.col("__before") + F.sum("size").over(inside) - F.col("size"))
        .drop("__order", "__part", "__before")
    )


def mix(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", carry: bool = False, seed: int = 7) -> DataFrame:
    """For each row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and ``pieces``.

    ``pieces`` lists (shard, first, last) word positions the mix takes; a document taken twice has its words in two
    shards or twice in one. ``carry`` adds the row itself as ``row``. A null or wordless text has size 0 and nothing is
    taken; a null source is a source of its own, the last one; of rows of one id, only those with one text are interchangeable. One row per source
    comes to the driver. An empty table gives an empty result.
    """
    source = F.col(f"`{source_column}`").cast("string")
    key = F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source))
    text = F.col(f"`{text_column}`").cast("string")
    rows = docs.select(
        key.alias("key"), F.col(f"`{id_column}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"), word_count(text).alias("size"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    if not carry:
        rows = written(rows, "word-counts")  # slim rows, needed three times
    sums = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    plans = {("+" + p["source"]) if p["source"] is not None else "-": p for p in plan({None if r["key"] == "-" else r["key"][1:]: int(r["size"]) for r in sums}, seed=seed)}
    placed = stream_offsets(rows, sum(r["rows"] for r in sums), seed)
    schema = placed.schema
    keep = [c for c in schema.names if c not in ("key", "text_hash", "start")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [plans[k] for k in batch.column("key").to_pylist()]
            pieces = [stream_pieces(p, s, n) for p, s, n in zip(own, batch.column("start").to_pylist(), batch.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in keep],
                    pa.array([p["size"] for p in own], pa.int64()),
                    pa.array([float(p["target"]) for p in own], pa.float64()),
                    pa.array([sum(b - a for _, a, b in x) for x in pieces], pa.int64()),
                    pa.array([[{"shard": s, "first": a, "last": b} for s, a, b in x] for x in pieces], pa.list_(pa.struct([("shard", pa.int32()), ("first", pa.int64()), ("last", pa.int64())]))),
                ],
                [*keep, "source_size", "target", "taken", "pieces"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name in keep)
    return by_batches(placed, run, f"{kept}, source_size bigint, target double, taken bigint, pieces array<struct<shard: int, first: bigint, last: bigint>>")


def mixed_documents(docs: DataFrame, **names: str) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, to the nearest whole number; half counts as one.

    Only the documents at the ends of a source's run of blocks are taken in part, so a source misses its target by a
    document or two.
    """
    found = mix(docs, carry=True, **names)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    copies = found.where(times > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), times)))
    return copies.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
