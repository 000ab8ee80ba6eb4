"""What the operators share of Spark: reading a table, scratch storage that all executors see, bounded broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Texts go to Python in batches of about this many rows; ``words.slices`` cuts them further by bytes.
BATCH_ROWS = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir``, or a checkpoint folder set before.

    Where neither is set, as in tests, a folder beside the warehouse is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        folder = f"{warehouse.rstrip('/')}/_scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in scratch storage."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to scratch storage and read back: they are computed once, and their lineage is cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with small batches, whatever the session's batch size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def small() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    yield batch.slice(at, BATCH_ROWS)

        return function(small())

    return df.mapInArrow(run, schema)


def by_runs(
    df: DataFrame, keys: list[str], function: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, rows: int = 20_000
) -> DataFrame:
    """Rows with equal ``keys`` brought together and given to ``function`` whole, many small groups at once.

    ``function`` gets tables sorted by ``keys`` that never cut a group. A group is held in memory, so callers bound
    its size by the choice of ``keys``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
            held.append(batch)
            n += batch.num_rows
            if n < rows:
                continue
            whole = pa.Table.from_batches(held)
            at = n - 1
            last = [whole.column(k)[at].as_py() for k in keys]
            cut = _first_of_run(whole, keys, last)
            if cut:
                yield from function(whole.slice(0, cut))
                held = whole.slice(cut).to_batches()
                n -= cut
        if n:
            yield from function(pa.Table.from_batches(held))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _first_of_run(whole: pa.Table, keys: list[str], last: list) -> int:
    low, high = 0, whole.num_rows - 1  # the last row belongs to the run; find the first that does
    columns = [whole.column(k) for k in keys]
    while low < high:
        middle = (low + high) // 2
        if [c[middle].as_py() for c in columns] == last:
            high = middle
        else:
            low = middle + 1
    return low


def runs(whole: pa.Table, keys: list[str]) -> list[tuple[int, int]]:
    """First and end of each run of equal ``keys`` (whole numbers without nulls)."""
    n = whole.num_rows
    change = np.zeros(n + 1, bool)
    change[[0, n]] = True
    for k in keys:
        column = whole.column(k).to_numpy()
        change[1:-1] |= column[1:] != column[:-1]
    at = np.flatnonzero(change)
    return list(zip(at[:-1].tolist(), at[1:].tolist()))
