"""Keys that hold so many rows that one task should not get them all."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Plans that read less than this by Spark's estimate hold no key too large for a task and are not measured.
MEASURED_BYTES = 256 << 20
#: A key is hot from this share of all rows on, and from this number of rows on.
HOT_SHARE = 1 / 500
HOT_ROWS = 200_000
#: What plans that are measured read for each task that they deal their rows to.
TASK_BYTES = 4 << 20
#: A distinct is dealt from this size of its columns on, to a task for each so many bytes of them.
DEALT_DISTINCT_BYTES = 8 << 20
DISTINCT_TASK_BYTES = 1 << 20
#: Up to this number of tasks a shuffle writes rows as they come (``spark.shuffle.sort.bypassMergeThreshold``); beyond it, a task
#: that writes holds the rows of its whole split. So tasks are filled up to so many times their bytes before there are more.
FEW_TASKS = 200
FILLED = 6
#: Spark estimates what it cannot know by a number beyond this.
UNKNOWN_BYTES = 1 << 60
#: Buckets that keys are counted in, by hash.
BUCKETS = 1 << 16


def _leaf_bytes(df: DataFrame) -> list[int]:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return [int(str(leaves.apply(at).stats().sizeInBytes())) for at in range(leaves.size())]


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of what a plan reads, from file sizes and the columns needed; nothing is run."""
    return sum(_leaf_bytes(df))


def column_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the input's share that is in the columns of ``df``; what it cannot know does not count."""
    read = sum(size for size in _leaf_bytes(df) if size < UNKNOWN_BYTES)
    return min(read, int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))


def tasks_for(size: int, task_bytes: float) -> int:
    """The number of tasks to deal rows to, of which so many bytes are read."""
    return max(1, math.ceil(max(min(size / task_bytes, FEW_TASKS), size / (FILLED * task_bytes))))


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by key to tasks whose number grows with what the plan reads; small inputs are left to adaptive execution.

    What follows on the same keys needs no other shuffle. Left to itself, Spark merges pieces until there are few tasks, so a
    task's share would grow with the input, and cuts ranked rows in the tasks before the shuffle, which sorts all of them once
    more. Inputs of unknown size, such as rows from the driver, are not counted.
    """
    size = sum(read for read in _leaf_bytes(df) if read < UNKNOWN_BYTES)
    return df if size < MEASURED_BYTES else df.repartition(tasks_for(size, TASK_BYTES), *keys)


def key_bucket(keys: Sequence[str | Column]) -> Column:
    hashed = F.xxhash64(*[F.col(f"`{k}`") if isinstance(k, str) else k for k in keys])
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str | Column], measured_bytes: int | None = None) -> list[int]:
    """Buckets of the keys that hold many rows of ``df``, at most ``1 / HOT_SHARE`` of them.

    One pass over the key columns counts rows by bucket, combined map-side; small inputs are not read. Some other keys share
    a bucket with a hot one. Which buckets are returned only decides on a plan, never on a result.
    """
    if input_bytes(df) < (MEASURED_BYTES if measured_bytes is None else measured_bytes):
        return []
    counted = df.groupBy(key_bucket(keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    many = F.when(F.col("n") >= HOT_ROWS, F.struct("bucket", "n"))
    found = counted.agg(F.sum("n").alias("rows"), F.collect_list(many).alias("many")).first()
    return sorted(entry["bucket"] for entry in found["many"] if entry["n"] >= found["rows"] * HOT_SHARE)


def has_key(keys: Sequence[str | Column], buckets: Sequence[int]) -> Column:
    """Whether a row's key is in one of the buckets that ``hot_keys`` returned."""
    return key_bucket(keys).isin(list(buckets))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows; those of a large input are dealt once, by their whole content, to tasks whose number grows with it.

    Left to itself, Spark gathers the distinct rows of a whole split before the shuffle and merges pieces after it until there
    are few, so what a task holds would grow with the input. Rows that are repeated very often are combined before their
    shuffle all the same, so that equal ones need not meet in one task.
    """
    size = column_bytes(df)
    if size < DEALT_DISTINCT_BYTES:
        return df.distinct()
    tasks = tasks_for(size, DISTINCT_TASK_BYTES)
    whole = [F.col(f"`{column}`") for column in df.columns]
    hot = hot_keys(df, whole, measured_bytes=0)
    if not hot:
        return df.repartition(tasks, *whole).distinct()
    is_hot = has_key(whole, hot)
    return df.filter(~is_hot).repartition(tasks, *whole).distinct().unionByName(df.filter(is_hot).distinct())
