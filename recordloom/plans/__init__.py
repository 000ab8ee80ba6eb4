"""Whole curation plans: record selection, assets, demographics snapshots."""

from recordloom.plans.assets import (
    build_covid_positive,
    build_individual,
    build_multisource,
    multisource,
    source_persons,
)
from recordloom.plans.demographics import new_versions, summarise_demographics, update_demographics
from recordloom.plans.selection import (
    SELECTIONS,
    SelectionSpec,
    TieGroup,
    select_date_of_birth,
    select_ethnicity,
    select_lsoa,
    select_records,
    select_sex,
)

__all__ = [
    "SELECTIONS",
    "SelectionSpec",
    "TieGroup",
    "build_covid_positive",
    "build_individual",
    "build_multisource",
    "multisource",
    "new_versions",
    "select_date_of_birth",
    "select_ethnicity",
    "select_lsoa",
    "select_records",
    "select_sex",
    "source_persons",
    "summarise_demographics",
    "update_demographics",
]
