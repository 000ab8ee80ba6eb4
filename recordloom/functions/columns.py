"""Value lookups, recodes and the deterministic replacement for a random order."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _keyed(column: Column, mapping: Mapping[Any, Any]) -> Column:
    """The column as text when the mapping is keyed by text, so that numeric columns are matched too."""
    return column.cast("string") if all(isinstance(key, str) for key in mapping) else column


def lookup(column: Column, mapping: Mapping[Any, Any]) -> Column:
    """Mapped value, null where the column value is not a key."""
    literals = [F.lit(item) for item in chain.from_iterable(mapping.items())]
    return F.create_map(*literals)[_keyed(column, mapping)]


def recoded(column: Column, mapping: Mapping[str, str | None]) -> Column:
    """Mapped value as text, the column itself where its value is not a key; a key may map to null."""
    text = column.cast("string")
    branches = None
    for key, value in mapping.items():
        value = F.lit(value).cast("string")
        branches = F.when(text == key, value) if branches is None else branches.when(text == key, value)
    return text if branches is None else branches.otherwise(text)


def boolean_or_false(condition: Column) -> Column:
    """A condition with unknown counted as not met."""
    return F.coalesce(condition, F.lit(False))


def seeded_order(seed: int, *columns: Column) -> Column:
    """Pseudo-random order key that depends on the values alone.

    The same rows get the same key however they are partitioned or recomputed, unlike ``rand(seed)``.
    """
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))
