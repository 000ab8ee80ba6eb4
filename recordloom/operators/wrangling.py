"""Reshaping, renaming and recoding, row by row; only a large lookup is joined by a shuffle."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import recoded
from recordloom.operators.codelists import BROADCAST_ROWS, fits_broadcast


def melt(
    df: DataFrame,
    id_vars: Iterable[str],
    value_vars: Iterable[str],
    var_name: str = "variable",
    value_name: str = "value",
    as_string: bool = False,
) -> DataFrame:
    """Wide to long: one row per input row and value column, nulls kept.

    The value columns need a common type; ``as_string`` casts them to text first.
    """
    ids, values = list(id_vars), list(value_vars)
    if as_string:
        df = df.withColumns({name: F.col(name).cast("string") for name in values})
    return df.unpivot(ids, values, var_name, value_name)


# A name is lower case, of letters, digits and underscores, and does not start with a digit.
_NOT_ALLOWED = re.compile(r"[\W]", re.UNICODE)
_LEADING_DIGIT_OR_EMPTY = re.compile(r"^(?=\d|$)")


def _clean(name: str) -> str:
    return _LEADING_DIGIT_OR_EMPTY.sub("_", _NOT_ALLOWED.sub("_", name.lower()), count=1)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names of letters, digits and underscores, none starting with a digit, all distinct.

    Repeated names get ``_2``, ``_3`` and so on, skipping suffixes that are taken.
    """
    names: list[str] = []
    for base in map(_clean, df.columns):
        name, count = base, 1
        while name in names:
            count += 1
            name = f"{base}_{count}"
        names.append(name)
    return df.toDF(*names)


# How a Python value becomes one of the type that all values of a mapping have in common.
_AS_TYPE: dict[type[T.DataType], Callable[[Any], Any]] = {
    T.DoubleType: float,
    T.FloatType: float,
    T.DecimalType: lambda value: Decimal(str(value)),
    T.StringType: lambda value: str(value).lower() if isinstance(value, bool) else str(value),
}


def _common_type(spark: SparkSession, values: Iterable[Any]) -> T.DataType:
    """The type Spark gives to values together, found from the extremes of each Python type; text if all are null."""
    extremes: dict[type, list[Any]] = {}
    for value in values:
        if value is None:
            continue
        known = extremes.setdefault(type(value), [value, value])
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            known[0], known[1] = min(known[0], value), max(known[1], value)
        elif isinstance(value, Decimal):
            known.append(value)
    if not extremes:
        return T.StringType()
    kept = [F.lit(value) for pair in extremes.values() for value in dict.fromkeys(pair)]
    return spark.range(0).select(F.array(*kept).alias("a")).schema["a"].dataType.elementType  # type: ignore[union-attr]


def _pairs(spark: SparkSession, mapping: Mapping[Any, Any]) -> DataFrame:
    """A mapping as a table ``__key``, ``__value``, each of one type, whatever the number of entries."""
    values = list(mapping.values())
    if any(isinstance(value, (dict, list, tuple, T.Row)) for value in values):
        sample = [(T.Row(**v) if isinstance(v, dict) else v,) for v in values if v is not None]
        value_type = spark.createDataFrame(sample, ["v"]).schema["v"].dataType
        values = [T.Row(**v) if isinstance(v, dict) else v for v in values]
    else:
        value_type = _common_type(spark, values)
        typed = _AS_TYPE.get(type(value_type), lambda value: value)
        values = [None if value is None else typed(value) for value in values]
    key_type = _common_type(spark, mapping)
    typed = _AS_TYPE.get(type(key_type), lambda value: value)
    schema = T.StructType([T.StructField("__key", key_type), T.StructField("__value", value_type)])
    return spark.createDataFrame([(typed(key), value) for key, value in zip(mapping, values) if key is not None], schema)


def map_values(
    df: DataFrame, mapping: Mapping[Any, Any] | DataFrame, column: str, new_column: str | None = None
) -> DataFrame:
    """Replace a column by its mapped value, or add it as a new column; unmapped values become null.

    The mapping is a dictionary or a lookup table (``key``, ``value``) of any size with unique keys, as from
    ``lookup_table``. Values, and keys, have one type together: the one Spark finds for all of them, so the result's
    type does not depend on how many there are. Values may be dictionaries (structs) or lists. A text key also
    reaches numeric columns. The lookup is broadcast if it is counted to be small.
    """
    if column not in df.columns:
        raise ValueError(f"Column {column!r} does not exist.")
    if not isinstance(mapping, DataFrame) and not mapping:
        raise ValueError("The mapping is empty.")
    if new_column and new_column in df.columns:
        raise ValueError(f"Column {new_column!r} already exists.")
    target = new_column or column
    if isinstance(mapping, DataFrame):
        pairs = mapping.select(F.col("key").alias("__key"), F.col("value").alias("__value"))
        small = fits_broadcast(pairs.select("__key", F.to_json(F.struct("__value"))))
    else:
        pairs = _pairs(df.sparkSession, mapping)
        small = len(mapping) <= BROADCAST_ROWS
    key_type = pairs.schema["__key"].dataType
    own = F.col(f"`{column}`").cast(key_type) if isinstance(key_type, T.StringType) else F.col(f"`{column}`")
    joined = df.join(F.broadcast(pairs) if small else pairs, own == F.col("__key"), "left")
    names = [*df.columns, *([target] if target not in df.columns else [])]
    return joined.select(*[F.col("__value").alias(n) if n == target else F.col(f"`{n}`") for n in names])


def recode(
    df: DataFrame, mapping: Mapping[str, str | None], column: str, new_column: str | None = None
) -> DataFrame:
    """Replace listed values and keep the others; the result is text and a value may map to null."""
    return df.withColumn(new_column or column, recoded(F.col(column), mapping))
