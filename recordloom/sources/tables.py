"""Catalog tables addressed by key: versioned load, save, archive versions, guarded CSV export."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.sources.standardise import Standard, standardise

VERSION_COLUMN = "archived_on"

# A directory maps a table key to {'database', 'table_name'} and at most one of 'archive_date' (a date or 'latest')
# and 'max_archive_date'.
Directory = Mapping[str, Mapping[str, str]]


def qualified_name(key: str, directory: Directory) -> str:
    """``database.table`` for a key of the directory."""
    if directory is None or key not in directory:
        raise KeyError(f"Table key {key!r} is not in the table directory.")
    return f"{directory[key]['database']}.{directory[key]['table_name']}"


def _typed(df: DataFrame, column: str, value) -> Column:
    # Typed like the column, so that the filter folds to a constant and prunes partitions.
    return F.lit(value).cast(df.schema[column].dataType)


def at_version(df: DataFrame, version: str, column: str = VERSION_COLUMN) -> DataFrame:
    """Rows of one archive version, given as ``'YYYY-MM-DD'`` or ``'latest'``.

    The latest version is looked up at once and filtered as a literal, which prunes partitions statically.
    """
    if version == "latest":
        version = df.agg(F.max(column)).first()[0]
    return df.filter(F.col(column) == _typed(df, column, version))


def up_to_version(df: DataFrame, version: str, column: str = VERSION_COLUMN) -> DataFrame:
    """Rows of archive versions up to and including one."""
    return df.filter(F.col(column) <= _typed(df, column, version))


def archive_versions(df: DataFrame, column: str = VERSION_COLUMN) -> DataFrame:
    """Distinct archive versions as text, ascending."""
    return df.select(F.col(column).cast("string").alias(column)).distinct().orderBy(column)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def stored_versions(spark: SparkSession, table: str, column: str = VERSION_COLUMN) -> list[str]:
    """Archive versions of a catalog table as text, ascending.

    For a table partitioned by version they come from the catalog, without a scan of the table.
    """
    df = spark.table(table)
    if column not in _partition_columns(spark, table):
        return [row[0] for row in archive_versions(df.filter(F.col(column).isNotNull()), column).collect()]
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_extract("partition", rf"(?:^|/){column}=([^/]+)", 1).alias("version")
    )
    listed = listed.filter("version <> '__HIVE_DEFAULT_PARTITION__'").distinct()
    typed = F.col("version").cast(df.schema[column].dataType)
    return [row[0] for row in listed.orderBy(typed).collect()]


def _latest_stored(spark: SparkSession, table: str, column: str = VERSION_COLUMN) -> DataFrame:
    df = spark.table(table)
    if column not in _partition_columns(spark, table):
        return at_version(df, "latest", column)
    # The catalog may list a partition without rows; the latest version is the last one that has any.
    for version in reversed(stored_versions(spark, table, column)):
        latest = at_version(df, version, column)
        if latest.select(F.lit(1)).take(1):
            return latest
    return df.filter(F.lit(False))


def load_table(
    spark: SparkSession,
    key: str,
    directory: Directory,
    method: str | Standard | None = None,
) -> DataFrame:
    """Table for a key, restricted to the archive version its entry names, optionally standardised."""
    name = qualified_name(key, directory)
    exact, upper = directory[key].get("archive_date"), directory[key].get("max_archive_date")
    if exact is not None and upper is not None:
        raise ValueError("Only one of 'archive_date' and 'max_archive_date' may be given.")
    if exact == "latest":
        df = _latest_stored(spark, name)
    elif exact is not None:
        df = at_version(spark.table(name), exact)
    elif upper is not None:
        df = up_to_version(spark.table(name), upper)
    else:
        df = spark.table(name)
    return df if method is None else standardise(df, method)


def save_table(
    df: DataFrame,
    key: str,
    directory: Directory,
    partition_by: str | Sequence[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write a managed table for a key, by default replacing it together with its schema.

    Partitioned writes are rebalanced by the partition columns: adaptive execution merges small pieces and splits
    a partition that holds much of the data, so neither many tiny files nor one overlong task results.

    A managed table is replaced by a staged write: the rows are written to a table beside it, which takes its name only when
    it is complete. A job that fails leaves the old rows, and ``df`` may read the table that it replaces; afterwards, it
    has to be loaded anew.
    """
    name = qualified_name(key, directory)
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if not all(isinstance(column, str) for column in columns):
        raise ValueError("partition_by must be a string or a list of strings.")
    if columns:
        df = df.hint("rebalance", *columns)
    spark = df.sparkSession
    if mode == "overwrite" and spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "MANAGED":
        _replace_table(df, name, columns)
    else:
        _write_table(df, name, columns, mode)


def _write_table(df: DataFrame, name: str, columns: list[str], mode: str) -> None:
    writer = df.write.mode(mode).option("overwriteSchema", "true")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.saveAsTable(name)


def _rename_table(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")
    if _partition_columns(spark, to):
        # the folder has moved, and a catalog may still list the partitions at their old places
        spark.sql(f"ALTER TABLE {to} RECOVER PARTITIONS")
    spark.catalog.refreshTable(to)  # a table of that name may have been read before


def _replace_table(df: DataFrame, name: str, columns: list[str]) -> None:
    """Write beside the table, and put the result in its place by renaming only when it is complete."""
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    staged, replaced = f"{name}__staged_{mark}", f"{name}__replaced_{mark}"
    try:
        _write_table(df, staged, columns, "errorifexists")
        _rename_table(spark, name, replaced)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    try:
        _rename_table(spark, staged, name)
    except Exception:
        _rename_table(spark, replaced, name)
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    spark.sql(f"DROP TABLE {replaced}")


def export_small_csv(df: DataFrame, path: str, max_rows: int = 1000, **options) -> None:
    """Write a small result, such as a disclosure-checked table, as one CSV file in the directory ``path``.

    Refuses an empty result, more than ``max_rows`` rows, or a path whose parent does not exist. A guard counts at
    most ``max_rows + 1`` rows, and the rows are written by a task, not by way of the driver. Quotes inside a field
    are doubled.
    """
    spark = df.sparkSession
    count = df.limit(max_rows + 1).count()
    if count > max_rows:
        raise ValueError(f"More than {max_rows} rows; use save_table for larger results.")
    if not count:
        raise ValueError("The result is empty.")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parent = target.getParent()
    if parent is not None and not files.exists(parent):
        raise ValueError(f"Directory {parent} does not exist.")
    try:
        one_file = df.limit(max_rows).coalesce(1)
        one_file.write.mode("overwrite").options(**({"header": "true", "escape": '"'} | options)).csv(path)
    except Exception as error:
        raise OSError(f"Writing CSV to {path} failed: {error}") from error
