"""Shards of near equal bytes by sampled splitters.

Rows are ordered by a key: the hash of their text, then of their id, so that copies lie together and any number of them
can still be parted. A size-weighted sample of keys gives the boundaries of many ranges; ranges that turn out overfull
are sampled again and subdivided. Only inside a range are rows put in order, so no task sees more than about two
ranges' rows, however many copies a text has. Laid end to end, the ranges give each row the bytes and rows before it:
the shard follows from the bytes, the slot from the rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys sampled for a range, on average.
OVERSAMPLING = 32
#: Ranges for each shard, at least.
RANGES_PER_SHARD = 8
#: Rows of a range, about, where that makes more ranges.
ROWS_PER_RANGE = 100_000
#: A range of more than so many times the mean size is subdivided.
OVERFULL = 2.0
#: Rounds of subdivision; a range left overfull after them is still right, only larger.
ROUNDS = 4
_SEED = 20_011


def text_key(text: Column, doc_id: Column) -> Column:
    """The upper half is the text's hash (null has one of its own), the lower half the id's."""
    upper = F.xxhash64(text).bitwiseAND(F.lit(-1 << 32))
    return upper.bitwiseOR(F.shiftrightunsigned(F.xxhash64(doc_id), 32))


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _range_of(boundaries: np.ndarray, key: Column) -> Column:
    """The range of a key: the number of boundaries not above it. They are a bounded list, sent with the function."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(boundaries, keys.to_numpy(np.int64), "right").astype(np.int32))

    return place(key)


def _sample(rows: DataFrame, weight_per_byte: float, where: Column | None, seed: int) -> np.ndarray:
    """Keys, each drawn with a chance in proportion to its size; the draw depends on the key alone."""
    chance = F.col("size") * F.lit(weight_per_byte)
    drawn = F.shiftrightunsigned(F.xxhash64(F.col("key"), F.lit(seed)), 11) / F.lit(float(1 << 53)) < chance
    found = rows.where(drawn if where is None else drawn & where).select("key", "size").toPandas()
    return found.sort_values("key")


def _quantiles(sample: pd.DataFrame, parts: int, weight_per_byte: float) -> np.ndarray:
    if sample.empty or parts < 2:
        return np.zeros(0, np.int64)
    # rows larger than a draw's share were certain, so they stand for their own size
    stands_for = np.maximum(sample["size"].to_numpy() * weight_per_byte, 1.0).cumsum()
    at = np.searchsorted(stands_for, stands_for[-1] * np.arange(1, parts) / parts)
    return np.unique(sample["key"].to_numpy()[np.minimum(at, len(sample) - 1)])


def splitters(rows: DataFrame, total: int, ranges: int) -> tuple[np.ndarray, pd.DataFrame]:
    """Boundaries of ranges over ``key``, and the exact size and rows of each range. One row a range comes to the driver."""
    per_byte = ranges * OVERSAMPLING / total
    boundaries = _quantiles(_sample(rows, per_byte, None, _SEED), ranges, per_byte)
    for round_ in range(ROUNDS + 1):
        of = _range_of(boundaries, F.col("key"))
        found = rows.groupBy(of.alias("range")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")).toPandas()
        over = found[(found["bytes"] > OVERFULL * total / ranges) & (found["low"] < found["high"])]
        if over.empty or round_ == ROUNDS:
            return boundaries, found.sort_values("range")
        per_byte = ranges * OVERSAMPLING / total * 4 ** (round_ + 1)
        inside = F.lit(False)
        for low, high in zip(over["low"].tolist(), over["high"].tolist()):
            inside = inside | F.col("key").between(low, high)
        sample = _sample(rows, per_byte, inside, _SEED + round_ + 1)
        new = [boundaries]
        for low, high, size in zip(over["low"], over["high"], over["bytes"]):
            part = sample[(sample["key"] >= low) & (sample["key"] <= high)]
            new.append(_quantiles(part, int(np.ceil(size * ranges / total)) + 1, per_byte))
        boundaries = np.unique(np.concatenate(new))


def _shard_of(before: Column, size: Column, total: int, shards: int) -> Column:
    """The shard of the middle of a row's bytes, in whole numbers: a quotient of decimals would be rounded to six places first."""
    place = (2 * before + size).cast("decimal(38,0)") * shards
    return F.least(F.call_function("div", place, F.lit(2 * total).cast("decimal(38,0)")), F.lit(shards - 1).cast("long")).cast("int")


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """``rows``, which has ``doc_id``, ``key`` and ``size``, with ``shard`` and ``slot``.

    A row goes where the middle of its bytes lies in the order of keys, so an end of a shard is off by half a row at most. Slots of a
    shard are numbered from 0 without gaps. Rows equal in key and id are interchangeable: which of them gets which slot is
    undefined. An empty table gives an empty result. Columns named ``__range``, ``__bytes`` or ``__row`` are not allowed.
    """
    totals = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    if not totals["rows"]:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    total = int(totals["bytes"])
    ranges = max(shards * RANGES_PER_SHARD, totals["rows"] // ROWS_PER_RANGE)
    boundaries, found = splitters(rows, total, ranges)
    before = found.assign(bytes_before=found["bytes"].cumsum() - found["bytes"], rows_before=found["rows"].cumsum() - found["rows"])
    starts = rows.sparkSession.createDataFrame(
        [(int(r), int(b), int(n)) for r, b, n in zip(before["range"], before["bytes_before"], before["rows_before"])],
        "__range int, __bytes_before long, __rows_before long",
    )
    inside = Window.partitionBy("__range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.withColumn("__range", _range_of(boundaries, F.col("key")))
        .withColumns({"__bytes": F.sum("size").over(inside) - F.col("size"), "__row": F.count(F.lit(1)).over(inside) - 1})
        .join(F.broadcast(starts), "__range")  # one row a range
        .withColumns({"__bytes": F.col("__bytes") + F.col("__bytes_before"), "__row": F.col("__row") + F.col("__rows_before")})
        .withColumn("shard", _shard_of(F.col("__bytes"), F.col("size"), total, shards))
    )
    firsts = placed.groupBy("shard").agg(F.min("__row").alias("__first"))
    return (
        placed.join(F.broadcast(firsts), "shard")  # one row a shard
        .withColumn("slot", F.col("__row") - F.col("__first"))
        .select(*[c for c in placed.columns if c not in ("__range", "__bytes", "__row", "__bytes_before", "__rows_before", "shard")], "shard", "slot")
    )


def shard(docs: DataFrame, shards: int, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot``; columns of these names are replaced.

    A null text has a size of 8 bytes, like an empty one; both kinds, null ids and repeated rows are placed like any row.
    """
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in own])
    text = F.col(f"`{text_column}`").cast("string")
    keyed = docs.select(row.alias("row"), F.col(f"`{id_column}`").alias("doc_id"), size_of(text).alias("size"), text_key(text, F.col(f"`{id_column}`")).alias("key"))
    return assign(keyed, shards).select(*[F.col("row").getField(c).alias(c) for c in own], "shard", "slot")
