"""Standardisation of loaded tables: person id, clean column names, dates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.functions import parsed_date, parsed_timestamp
from recordloom.operators.wrangling import clean_column_names


@dataclass(frozen=True)
class Standard:
    """Renames (matched without regard to case), then clean names, then parsed columns by pattern."""

    renames: dict[str, str]
    dates: dict[str, str] = field(default_factory=dict)
    timestamps: dict[str, str] = field(default_factory=dict)
    # Columns whose whole text must match a regular expression to be parsed.
    shapes: dict[str, str] = field(default_factory=dict)


_DAY = "yyyyMMdd"
_PERSON = Standard({"PERSON_ID_DEID": "person_id"})

STANDARDISE_METHODS: dict[str, Standard] = {
    "deaths": Standard(
        {"DEC_CONF_NHS_NUMBER_CLEAN_DEID": "person_id", "REG_DATE_OF_DEATH": "date_of_death"},
        dates={"reg_date": _DAY, "date_of_death": _DAY},
        shapes={"date_of_death": r"\d{8}"},
    ),
    "gdppr": Standard({"NHS_NUMBER_DEID": "person_id"}),
    "hes_apc": _PERSON,
    "hes_op": _PERSON,
    "hes_ae": _PERSON,
    "pillar_2": _PERSON,
    "ssnap": _PERSON,
    "sgss": _PERSON,
    "vaccine_status": Standard(
        {"PERSON_ID_DEID": "person_id"},
        dates={"recorded_date": _DAY, "expiry_date": _DAY},
        timestamps={"date_and_time": "yyyyMMdd'T'HHmmssSS"},
    ),
    "primary_care_meds": _PERSON,
    "chess": _PERSON,
}


def standardise(df: DataFrame, method: str | Standard) -> DataFrame:
    """Apply a named standardisation, or one given as a ``Standard``. Text that is no date becomes null."""
    if isinstance(method, str):
        if method not in STANDARDISE_METHODS:
            raise ValueError(f"Unknown method {method!r}; available: {', '.join(STANDARDISE_METHODS)}.")
        method = STANDARDISE_METHODS[method]
    df = clean_column_names(df.withColumnsRenamed(method.renames))
    parsed = {name: parsed_date(F.col(name), pattern, method.shapes.get(name)) for name, pattern in method.dates.items()}
    parsed |= {name: parsed_timestamp(F.col(name), pattern) for name, pattern in method.timestamps.items()}
    return df.withColumns(parsed) if parsed else df
