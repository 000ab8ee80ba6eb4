"""Multi-source and individual tables of the curated assets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from recordloom.operators.codelists import read_codelist
from recordloom.operators.filters import require
from recordloom.plans.selection import SELECTIONS, SelectionSpec, select_records
from recordloom.sources.codelist_values import packaged_codelist
from recordloom.sources.extracts import ASSETS, Asset, Codelist, combine_sources, extract, scans
from recordloom.sources.tables import Directory, load_table, save_table

_PACKAGED = ("antigen_tests", "infection_snomed")


def _codelists(
    spark: SparkSession, asset: Asset, methods: Sequence[str], given: Mapping[str, DataFrame | str]
) -> dict[str, Codelist]:
    """The codelists the sources need: the caller's (tables or paths of CSV files), checked for size once, else the packaged ones."""
    needed = {asset.sources[m].codelist for m in methods} - {None}
    missing = sorted(needed - given.keys() - set(_PACKAGED))
    if missing:
        users = [m for m in methods if asset.sources[m].codelist in missing]
        raise ValueError(f"Sources {', '.join(users)} need codelists that were not given: {', '.join(missing)}.")
    lists = {}
    for name in needed:
        if name not in given:
            lists[name] = Codelist(packaged_codelist(spark, name), True)
        else:
            rows = given[name]
            lists[name] = Codelist.checked(read_codelist(spark, rows) if isinstance(rows, str) else rows)
    return lists


def multisource(
    spark: SparkSession,
    asset: str | Asset,
    directory: Directory,
    methods: Sequence[str] | None = None,
    codelists: Mapping[str, DataFrame | str] | None = None,
) -> DataFrame:
    """The long table of an asset over the chosen sources, not saved.

    Codelists by name, as tables or as paths of CSV files: ``ethnicity_snomed`` (code, description, ethnic_category)
    and ``infection_icd10`` (code, description, covid_status) come from the caller, as such lists have hundreds of
    entries and change; ``antigen_tests`` and ``infection_snomed`` are packaged and may be replaced. What is missing is
    reported before any table is opened.
    """
    asset = ASSETS[asset] if isinstance(asset, str) else asset
    methods = asset.chosen(methods)
    lists = _codelists(spark, asset, methods, codelists or {})
    extracts = []
    for labels in scans(asset, methods):
        spec = asset.sources[labels[0]]
        extracts.append(extract(load_table(spark, spec.table, directory, spec.method), asset, labels, lists))
    return combine_sources(extracts)


def source_persons(
    spark: SparkSession,
    asset: str | Asset,
    directory: Directory,
    methods: Sequence[str] | None = None,
) -> DataFrame:
    """The person ids of the source tables, as often as they occur: ``persons`` of a selection from an unsaved long table."""
    asset = ASSETS[asset] if isinstance(asset, str) else asset
    specs = [asset.sources[method] for method in asset.chosen(methods)]
    tables = [load_table(spark, spec.table, directory, spec.method).select("person_id") for spec in specs]
    return require(combine_sources(tables), ["person_id"])


def build_multisource(
    spark: SparkSession,
    asset: str | Asset,
    directory: Directory,
    table: str | None = None,
    methods: Sequence[str] | None = None,
    codelists: Mapping[str, DataFrame | str] | None = None,
) -> None:
    """Save the long table of an asset, by default under the key ``<asset>_multisource``."""
    name = asset if isinstance(asset, str) else asset.name
    save_table(multisource(spark, asset, directory, methods, codelists), table or f"{name}_multisource", directory)


def build_covid_positive(
    spark: SparkSession,
    directory: Directory,
    table: str = "covid_positive",
    methods: Sequence[str] | None = None,
    codelists: Mapping[str, DataFrame | str] | None = None,
) -> None:
    """Save the positive COVID-19 records of the chosen sources."""
    build_multisource(spark, "covid_positive", directory, table, methods, codelists)


def build_individual(
    spark: SparkSession,
    asset: str,
    directory: Directory,
    table_multisource: str | None = None,
    table_individual: str | None = None,
    spec: SelectionSpec | None = None,
    **options,
) -> None:
    """Select one record per person from a saved long table and save the result.

    Keys default to ``<asset>_multisource`` and ``<asset>_individual``. Options are those of ``select_records``.
    """
    spec = spec or SELECTIONS[asset]
    rows = load_table(spark, table_multisource or f"{asset}_multisource", directory)
    save_table(select_records(rows, spec, **options), table_individual or f"{asset}_individual", directory)
