"""First rows, ranks and dense ranks, per group or over a whole table."""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.operators.codelists import BROADCAST_ROWS
from recordloom.operators.hot_keys import has_key, hot_keys

_METHODS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}
_ORDER_TEXT = re.compile(r"^\s*(.+?)(?:\s+(asc|desc))?(?:\s+nulls\s+(first|last))?\s*$", re.IGNORECASE | re.DOTALL)

OrderKey = str | Column


def _listed(items: str | Column | Sequence | None) -> list:
    if items is None:
        return []
    return [items] if isinstance(items, (str, Column)) else list(items)


def _order_parts(key: OrderKey, columns: Collection[str] = ()) -> tuple[Column, str]:
    """The value to order by, and the Column method that gives its direction.

    Text is a column name, or SQL, with an optional direction. Of a Column such as ``F.col('x').desc()`` the value and the
    direction are taken from its expression; a Column without direction ascends.
    """
    if isinstance(key, str):
        match = _ORDER_TEXT.match(key)
        if key in columns or match is None:
            return F.col(f"`{key}`"), "asc_nulls_first"
        value, direction, nulls = match[1], (match[2] or "asc").lower(), match[3]
        nulls = (nulls or ("first" if direction == "asc" else "last")).lower()
        return F.col(f"`{value}`") if value in columns else F.expr(value), f"{direction}_nulls_{nulls}"
    node = key._jc.node()
    if node.getClass().getSimpleName() != "SortOrder":
        return key, "asc_nulls_first"
    jvm = SparkSession.active()._jvm
    value = type(key)(jvm.org.apache.spark.sql.Column(node.child()))
    direction = "asc" if "Asc" in node.sortDirection().toString() else "desc"
    nulls = "first" if "First" in node.nullOrdering().toString() else "last"
    return value, f"{direction}_nulls_{nulls}"


def order_column(key: OrderKey) -> Column:
    """Sort column for ``'name'``, ``'name desc nulls last'`` or a Column."""
    if isinstance(key, Column):
        return key
    value, method = _order_parts(key)
    return getattr(value, method)()


def top_rows(
    df: DataFrame,
    method: str,
    n: int = 1,
    partition_by: str | Sequence[str] | None = None,
    order_by: OrderKey | Sequence[OrderKey] | None = None,
    return_index_column: bool = False,
    index_column_name: str = "row_index",
    heavy_ties: bool | None = None,
) -> DataFrame:
    """Rows whose index within their group is at most ``n``.

    ``method`` is ``row_number``, ``rank`` (ties share an index and leave a gap) or ``dense_rank`` (no gap).
    Order keys are Columns or text such as ``'age desc nulls last'``; the default places nulls first when ascending.

    Per group, Spark drops rows beyond rank ``n`` in every task before the shuffle, so a large group shrinks to
    its candidates first. What it cannot shrink are rows that tie within the first ``n``, so ranks can also be worked out
    on counted distinct keys and joined back, where adaptive execution may split a hot key over many tasks, for a
    shuffle more. By default only groups that a sketch of the group keys finds to hold very many rows go this way, and inputs
    too small for that are not measured (see ``hot_keys``); ``heavy_ties`` sends all groups or none of them. Ranks over a
    whole table always go this way, where the keys to join back are at most ``n``.
    """
    if method not in _METHODS:
        raise ValueError(f"Unknown method {method!r}; allowed are {', '.join(_METHODS)}.")
    if not isinstance(n, int) or isinstance(n, bool) or n < 1:
        raise ValueError("n must be a positive integer.")
    groups, keys = _listed(partition_by), _listed(order_by)
    if not keys:
        raise ValueError("order_by is required.")

    if method == "row_number" and not groups:
        # A bounded sort; what remains has n rows.
        indexed = df.orderBy(*map(order_column, keys)).limit(n)
        if return_index_column:
            indexed = indexed.withColumn(index_column_name, F.row_number().over(_window([], keys)))
    elif method != "row_number" and (heavy_ties or not groups):
        indexed = _ranked_by_distinct_key(df, method, n, groups, keys, index_column_name)
    else:
        measured = method != "row_number" and heavy_ties is None
        hot = hot_keys(df, groups) if measured else []
        rest = df.filter(~has_key(groups, hot)) if hot else df
        index = _METHODS[method]().over(_window(groups, keys))
        indexed = rest.withColumn(index_column_name, index).filter(F.col(index_column_name) <= n)
        if hot:
            heavy = df.filter(has_key(groups, hot))
            indexed = indexed.unionByName(_ranked_by_distinct_key(heavy, method, n, groups, keys, index_column_name))
    return indexed if return_index_column else indexed.drop(index_column_name)


def _window(groups: list, keys: list[OrderKey]):
    window = Window.orderBy(*map(order_column, keys))
    return window.partitionBy(*groups) if groups else window


def _ranked_by_distinct_key(
    df: DataFrame, method: str, n: int, groups: list[str | Column], keys: list[OrderKey], index_name: str
) -> DataFrame:
    """Order keys and groups become helper columns, so computed ones are ranked like plain ones."""
    parts = [_order_parts(key, df.columns) for key in keys]
    held = {f"__group_{i}": F.col(f"`{g}`") if isinstance(g, str) else g for i, g in enumerate(groups)}
    by_group = list(held)
    held |= {f"__key_{i}": value for i, (value, _) in enumerate(parts)}
    keyed = df.withColumns(held)
    counted = keyed.groupBy(*held).agg(F.count(F.lit(1)).alias("__rows"))
    order = [getattr(F.col(f"__key_{i}"), direction)() for i, (_, direction) in enumerate(parts)]
    if groups:
        window = Window.partitionBy(*by_group).orderBy(*order)
    else:
        counted = counted.orderBy(*order).limit(n)
        window = Window.orderBy(*order)
    first = counted.withColumn("__place", F.row_number().over(window)).filter(F.col("__place") <= n)
    if method == "dense_rank":
        ranked = first.withColumn(index_name, F.col("__place"))
    else:
        ahead = F.sum("__rows").over(window.rowsBetween(Window.unboundedPreceding, -1))
        ranked = first.withColumn(index_name, F.coalesce(ahead, F.lit(0)) + 1).filter(F.col(index_name) <= n)
        ranked = ranked.withColumn(index_name, F.col(index_name).cast("int"))
    ranked = ranked.select(*[F.col(name).alias(f"{name}_of") for name in held], index_name)
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"{name}_of")) for name in held])
    # Over a whole table there are at most n keys to join back.
    small = not groups and n <= BROADCAST_ROWS
    joined = keyed.join(F.broadcast(ranked) if small else ranked, same, "inner")
    return joined.drop(*held, *[f"{name}_of" for name in held])


def first_row(df: DataFrame, n: int = 1, partition_by=None, order_by=None, **kwargs) -> DataFrame:
    """First ``n`` rows of each group; see ``top_rows``."""
    return top_rows(df, "row_number", n, partition_by, order_by, **kwargs)


def first_rank(
    df: DataFrame, n: int = 1, partition_by=None, order_by=None, index_column_name: str = "rank_index", **kwargs
) -> DataFrame:
    """Rows of rank at most ``n`` in each group; see ``top_rows``."""
    return top_rows(df, "rank", n, partition_by, order_by, index_column_name=index_column_name, **kwargs)


def first_dense_rank(
    df: DataFrame, n: int = 1, partition_by=None, order_by=None, index_column_name: str = "dense_rank_index", **kwargs
) -> DataFrame:
    """Rows of dense rank at most ``n`` in each group; see ``top_rows``."""
    return top_rows(df, "dense_rank", n, partition_by, order_by, index_column_name=index_column_name, **kwargs)
