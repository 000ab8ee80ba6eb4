"""DataFrame to DataFrame operators."""

from recordloom.operators.codelists import (
    fits_broadcast,
    lookup_mapping,
    lookup_table,
    match_codelist,
    read_codelist,
)
from recordloom.operators.cohort import (
    apply_inclusion_criteria,
    flag_inclusion,
    inclusion_flowchart,
)
from recordloom.operators.filters import exclude_codes, filter_sources, require, within_dates
from recordloom.operators.privacy import redact_low_counts, round_counts
from recordloom.operators.top_rows import first_dense_rank, first_rank, first_row, top_rows
from recordloom.operators.wrangling import clean_column_names, map_values, melt, recode

__all__ = [
    "apply_inclusion_criteria",
    "clean_column_names",
    "exclude_codes",
    "filter_sources",
    "first_dense_rank",
    "first_rank",
    "first_row",
    "fits_broadcast",
    "flag_inclusion",
    "inclusion_flowchart",
    "lookup_mapping",
    "lookup_table",
    "map_values",
    "match_codelist",
    "melt",
    "read_codelist",
    "recode",
    "redact_low_counts",
    "require",
    "round_counts",
    "top_rows",
    "within_dates",
]
