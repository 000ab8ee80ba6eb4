"""Codelists and lookups: read as Spark CSV scans with text columns, matched by joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_CHARACTERS = 50_000_000
#: Words of 64 bits of a key filter, about ten bits a key for lists of 1.6 million keys.
FILTER_WORDS = 1 << 18


def read_codelist(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, keep_empty: bool = True, **options
) -> DataFrame:
    """CSV with a header, every column as text so that codes keep their digits and leading zeros.

    A quote inside a quoted field is doubled, as usual in CSV. Empty fields stay empty text, as in the reference data where ``''`` is a value; ``keep_empty=False`` makes them
    null. ``columns`` selects by name from the header.
    """
    options = {"header": "true", "inferSchema": "false", "enforceSchema": "false", "multiLine": "true", "escape": '"'} | options
    df = spark.read.options(**options).csv(path)
    if columns is not None:
        df = df.select(*columns)
    return df.fillna("") if keep_empty else df


def _first_duplicate_key(df: DataFrame, key: str):
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()


def lookup_table(
    spark: SparkSession,
    path: str,
    key: str,
    values: str | Sequence[str],
    retain_column_names: bool = False,
    key_type: str = "string",
) -> DataFrame:
    """Lookup from a CSV with a unique key: columns ``key``, of ``key_type``, and ``value``, text.

    Several value columns give a struct when ``retain_column_names`` is set, an array otherwise. ``map_values`` takes
    such a lookup of any size.
    """
    names = [values] if isinstance(values, str) else list(values)
    table = read_codelist(spark, path, keep_empty=False)
    if _first_duplicate_key(table, key):
        raise ValueError(f"Key column {key!r} is not unique.")
    if len(names) == 1:
        value = F.col(names[0])
    else:
        value = F.struct(*names) if retain_column_names else F.array(*names)
    return table.select(F.col(key).cast(key_type).alias("key"), value.alias("value"))


def lookup_mapping(table: DataFrame) -> dict:
    """A whole lookup (columns ``key`` and ``value``) as a dictionary on the driver.

    ``map_values`` takes the lookup as it is, without the way over the driver.
    """
    rows = table.select("key", "value").collect()
    return {r["key"]: r["value"].asDict() if isinstance(r["value"], T.Row) else r["value"] for r in rows}


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_characters: int = BROADCAST_CHARACTERS) -> bool:
    """Whether a table is small enough to send to every executor, by counting at most ``max_rows + 1`` rows."""
    size = F.length(F.concat_ws("", *[F.col(name).cast("string") for name in df.columns]))
    rows, characters = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows <= max_rows and (characters or 0) <= max_characters


def key_filter(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows of ``df`` whose key may be among ``keys``: all that are, and few others.

    The hashes of the keys set bits of a map of ``FILTER_WORDS`` words, whose size is therefore known however many
    keys there are; it is broadcast, so what cannot match never reaches a shuffle. A map of very many keys lets more
    pass, never less. Keys of different types are compared by casts that hashes do not know, so they are not filtered.
    """
    kinds = {df.schema[on].dataType, keys.schema[on].dataType}
    if len(kinds) > 1 or not isinstance(kinds.pop(), (T.StringType, T.IntegralType, T.DateType)):
        return df
    place = lambda column: F.pmod(F.xxhash64(column), F.lit(64 * FILTER_WORDS))
    word = lambda column: F.shiftright(place(column), 6)
    bit = lambda column: F.pmod(place(column), F.lit(64)).cast("int")
    known = keys.filter(F.col(on).isNotNull()).select(word(F.col(on)).alias("__word"), bit(F.col(on)).alias("__bit"))
    bits = known.groupBy("__word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__bit"))).alias("__bits"))
    same = (word(df[on]) == F.col("__word")) & (F.getbit(F.col("__bits"), bit(df[on])) == 1)
    return df.join(F.broadcast(bits), same, "left_semi")


def match_codelist(
    df: DataFrame,
    codelist: DataFrame,
    on: str = "code",
    how: str = "inner",
    small: bool | None = None,
) -> DataFrame:
    """Attach a codelist by code: ``inner`` keeps listed rows, ``left`` keeps all, ``left_semi`` only filters.

    The codelist is broadcast when it is proven small: by the caller (``small=True``, for lists fixed in code) or by
    a bounded count. A larger one is joined by a shuffle, which adaptive execution splits where a code is hot; unless all
    rows are kept, those whose code cannot be listed are left out before it (``key_filter``).
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"Unknown join type {how!r}.")
    if small is None:
        small = fits_broadcast(codelist)
    if small:
        return df.join(F.broadcast(codelist), on, how)
    return (df if how == "left" else key_filter(df, codelist, on)).join(codelist, on, how)
