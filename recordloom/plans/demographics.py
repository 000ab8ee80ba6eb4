"""Versioned demographics snapshots, kept up to date by adding the versions that are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.filters import require
from recordloom.sources.tables import (
    VERSION_COLUMN,
    Directory,
    archive_versions,
    load_table,
    qualified_name,
    save_table,
    stored_versions,
)

DEMOGRAPHIC_COLUMNS = (
    VERSION_COLUMN,
    "person_id",
    "practice",
    "reporting_period_end_date",
    "sex",
    "lsoa",
    "ethnic",
    "year_month_of_birth",
)


def summarise_demographics(records: DataFrame) -> DataFrame:
    """Distinct demographics of known persons per archive version."""
    return require(records, ["person_id"]).select(*DEMOGRAPHIC_COLUMNS).distinct()


def new_versions(source: DataFrame, existing: DataFrame) -> DataFrame:
    """Archive versions of the source, as text, that the existing snapshot lacks; a null version is none."""
    return require(archive_versions(source), [VERSION_COLUMN]).join(archive_versions(existing), VERSION_COLUMN, "left_anti")


def version_fingerprints(records: DataFrame) -> DataFrame:
    """(archived_on as text, n, fingerprint) of each archive version: rows, and a sum of row hashes that knows no order.

    Of the columns that the snapshot is made from; combined map-side into a row a version and task.
    """
    known = require(records, [VERSION_COLUMN, "person_id"]).select(*DEMOGRAPHIC_COLUMNS)
    digest = F.xxhash64(*known.columns).cast("decimal(38,0)")
    return known.groupBy(F.col(VERSION_COLUMN).cast("string").alias(VERSION_COLUMN)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(digest).cast("string").alias("fingerprint")
    )


def changed_versions(source: DataFrame, recorded: DataFrame) -> DataFrame:
    """Versions whose fingerprint in ``source`` differs from the recorded one, or is gone, or was never recorded."""
    now = version_fingerprints(source).withColumnsRenamed({"n": "n_now", "fingerprint": "now"})
    both = now.join(recorded.select(VERSION_COLUMN, "n", "fingerprint"), VERSION_COLUMN, "full")
    same = F.col("n").eqNullSafe(F.col("n_now")) & F.col("fingerprint").eqNullSafe(F.col("now"))
    return both.filter(~same).select(VERSION_COLUMN, F.col("now").isNull().alias("gone"))


def _replacing_only_written_partitions(spark: SparkSession) -> SparkSession:
    """A session over the same catalog for a write that leaves other partitions alone.

    The writer option of the same meaning is not honoured by insertInto, and a setting of the caller's session would
    reach other writes that run meanwhile.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return own


def update_demographics(
    spark: SparkSession,
    directory: Directory,
    source: str = "gdppr_all_versions",
    target: str = "gdppr_demographics_all_versions",
    update_all: bool = False,
    method: str | None = "gdppr",
    fingerprints: str | None = None,
) -> list[str]:
    """Summarise the archive versions missing from the target and add them; returns their dates as text.

    With ``fingerprints``, a key of the directory, a fingerprint of every version is kept in a table beside the snapshot, and
    versions whose content has changed since are built again too, or emptied if they are gone. That reads the needed columns of
    all versions; without it, a version that is there is taken to be right.

    The versions are listed once and filtered as literals, so only their partitions are read. Each one replaces its
    own partition, which leaves the others untouched and makes a repeated or interrupted update harmless. A missing
    target, or ``update_all``, builds every version. Records without a version are in no snapshot, neither in a first
    build nor in an update.
    """
    records = require(load_table(spark, source, directory, method), [VERSION_COLUMN])
    name = qualified_name(target, directory)
    source_restricted = {"archive_date", "max_archive_date"} & {k for k, v in directory[source].items() if v}
    if source_restricted:
        versions = [row[0] for row in archive_versions(records).collect() if row[0] is not None]
    else:
        versions = stored_versions(spark, qualified_name(source, directory))

    if update_all or not spark.catalog.tableExists(name):
        save_table(summarise_demographics(records), target, directory, VERSION_COLUMN)
        if fingerprints is not None:
            save_table(version_fingerprints(records), fingerprints, directory)
        return versions

    present = set(stored_versions(spark, name))
    missing = [version for version in versions if version not in present]
    gone: list[str] = []
    if fingerprints is not None:
        recorded = spark.createDataFrame([], f"{VERSION_COLUMN} string, n long, fingerprint string")
        if spark.catalog.tableExists(qualified_name(fingerprints, directory)):
            recorded = load_table(spark, fingerprints, directory)
        changed = changed_versions(records, recorded).collect()  # one row a version at most
        gone = sorted(row[0] for row in changed if row["gone"] and row[0] in present)
        missing = sorted({*missing, *[row[0] for row in changed if not row["gone"]]})
    for version in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({VERSION_COLUMN} = '{version}')")
    if missing:
        own = _replacing_only_written_partitions(spark)
        again = load_table(own, source, directory, method)
        kind = again.schema[VERSION_COLUMN].dataType
        wanted = again.filter(F.col(VERSION_COLUMN).isin([F.lit(v).cast(kind) for v in missing]))
        columns = spark.table(name).columns
        added = summarise_demographics(wanted).select(*columns).hint("rebalance", VERSION_COLUMN)
        added.write.mode("overwrite").insertInto(name)
        spark.catalog.refreshTable(name)  # the caller's session may remember the files that were there
    if fingerprints is not None and (missing or gone):
        # last, so that an interrupted update is done again
        save_table(version_fingerprints(records), fingerprints, directory)
    return sorted({*missing, *gone}) if gone else missing
