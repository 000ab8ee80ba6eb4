"""Row filters. Each one is a plain predicate, so it is pushed to the scan where the source allows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions import as_bound


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows in which none of the columns is null."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def within_dates(
    df: DataFrame,
    column: str,
    minimum: str | dt.date | Column | None = None,
    maximum: str | dt.date | Column | None = None,
) -> DataFrame:
    """Rows whose date lies within inclusive bounds; a bound that is None is open.

    Bounds are date instructions (see ``date_bound``) and may refer to other columns.
    """
    if minimum is not None:
        df = df.filter(F.col(column) >= as_bound(minimum))
    if maximum is not None:
        df = df.filter(F.col(column) <= as_bound(maximum))
    return df


def check_sources(sources: Sequence[str], allowed: Collection[str]) -> None:
    if not isinstance(sources, list):
        raise ValueError("filter_data_sources must be a list.")
    if not sources:
        raise ValueError("filter_data_sources must not be empty.")
    unknown = [source for source in sources if not isinstance(source, str) or source not in allowed]
    if unknown:
        raise ValueError(f"Unknown data sources {unknown}; allowed are {sorted(allowed)}.")


def filter_sources(df: DataFrame, sources: list[str] | None, allowed: Collection[str] | None = None) -> DataFrame:
    """Rows of the listed data sources; None keeps every source."""
    if sources is None:
        return df
    check_sources(sources, sources if allowed is None and isinstance(sources, list) else allowed or ())
    return df.filter(F.col("data_source").isin(sources))


def exclude_codes(df: DataFrame, column: str, codes: Collection[str]) -> DataFrame:
    """Rows whose code is known and not among the excluded ones."""
    df = df.filter(F.col(column).isNotNull())
    return df.filter(~F.col(column).isin(list(codes))) if codes else df
