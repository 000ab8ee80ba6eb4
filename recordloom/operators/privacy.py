"""Statistical disclosure control for counts. Row-local."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _check_columns(df: DataFrame, columns: list[str]) -> None:
    if not isinstance(columns, list) or not all(isinstance(name, str) for name in columns):
        raise TypeError("columns must be a list of strings.")
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"Columns not found: {missing}.")


def _check_positive(value: int, label: str) -> None:
    if not isinstance(value, int) or isinstance(value, bool) or value <= 0:
        raise ValueError(f"{label} must be a positive integer.")


def round_counts(df: DataFrame, columns: list[str], multiple: int = 5) -> DataFrame:
    """Round counts to the nearest multiple, halves away from zero; integer columns stay integer."""
    _check_columns(df, columns)
    _check_positive(multiple, "multiple")

    def rounded(name: str):
        value = F.round(F.col(name) / multiple) * multiple
        kind = df.schema[name].dataType
        return value.cast(kind) if isinstance(kind, T.IntegralType) else value

    return df.withColumns({name: rounded(name) for name in columns})


def redact_low_counts(
    df: DataFrame, columns: list[str], threshold: int, redaction_value: str | int | None = None
) -> DataFrame:
    """Replace counts below the threshold, and unknown counts, by a value.

    A text value turns the columns into text.
    """
    _check_positive(threshold, "threshold")
    _check_columns(df, columns)

    def redacted(name: str):
        shown = F.col(name).cast("string") if isinstance(redaction_value, str) else F.col(name)
        return F.when(F.col(name) >= threshold, shown).otherwise(F.lit(redaction_value))

    return df.withColumns({name: redacted(name) for name in columns})
