"""Catalog tables, their standardisation, and the extracts read from them."""

from recordloom.sources.codelist_values import (
    ANTIGEN_TESTS,
    ETHNICITY_CATEGORIES,
    ETHNICITY_PRE_2003,
    INFECTION_CODES,
    packaged_codelist,
)
from recordloom.sources.extracts import (
    ASSETS,
    Asset,
    SourceSpec,
    combine_sources,
    extract,
)
from recordloom.sources.standardise import STANDARDISE_METHODS, Standard, standardise
from recordloom.sources.tables import (
    archive_versions,
    at_version,
    export_small_csv,
    load_table,
    save_table,
    up_to_version,
)

__all__ = [
    "ANTIGEN_TESTS",
    "ASSETS",
    "Asset",
    "ETHNICITY_CATEGORIES",
    "ETHNICITY_PRE_2003",
    "INFECTION_CODES",
    "STANDARDISE_METHODS",
    "SourceSpec",
    "Standard",
    "archive_versions",
    "at_version",
    "combine_sources",
    "export_small_csv",
    "extract",
    "load_table",
    "packaged_codelist",
    "save_table",
    "standardise",
    "up_to_version",
]
