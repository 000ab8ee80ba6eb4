"""Column builders: date bounds, age arithmetic, lookups, recodes, seeded ordering."""

from recordloom.functions.columns import (
    boolean_or_false,
    lookup,
    recoded,
    seeded_order,
)
from recordloom.functions.dates import (
    as_bound,
    date_bound,
    dob_from_age,
    parsed_date,
    parsed_timestamp,
)

__all__ = [
    "as_bound",
    "boolean_or_false",
    "date_bound",
    "dob_from_age",
    "lookup",
    "parsed_date",
    "parsed_timestamp",
    "recoded",
    "seeded_order",
]
