"""Cohort inclusion by named SQL criteria, with an attrition flowchart."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import boolean_or_false


def _steps(criteria: Mapping[str, str]) -> list[str]:
    return [f"criteria_{i}" for i in range(len(criteria) + 1)]


def _check_criteria(criteria: Mapping[str, str]) -> None:
    if not isinstance(criteria, dict):
        raise TypeError("Criteria must be a dictionary of name to SQL predicate.")
    for name, predicate in criteria.items():
        if not isinstance(predicate, str):
            raise TypeError(f"Criterion {name!r} must be SQL text, not {type(predicate).__name__}.")


def _check_columns(cohort: DataFrame, criteria: Mapping[str, str], row_id_col: str, person_id_col: str) -> None:
    made = {"include", *criteria}
    clashes = [c for c in cohort.columns if c.startswith("criteria_") or c in made]
    clashes += [c for c in criteria if c == "include" or c.startswith("criteria_")]
    if clashes:
        raise ValueError(f"Columns clash with inclusion columns: {', '.join(sorted(clashes))}.")
    missing = [c for c in (row_id_col, person_id_col) if c not in cohort.columns]
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}.")


def flag_inclusion(cohort: DataFrame, criteria: Mapping[str, str]) -> DataFrame:
    """Add a boolean per criterion, cumulative ``criteria_0..k`` and ``include``.

    A criterion that is unknown for a row counts as not met. A criterion may refer to an earlier one by name.
    """
    _check_criteria(criteria)
    flagged = cohort
    for name, predicate in criteria.items():
        flagged = flagged.withColumn(name, F.expr(predicate))
    for name in criteria:
        if not isinstance(flagged.schema[name].dataType, (T.BooleanType, T.NullType)):
            kind = flagged.schema[name].dataType.simpleString()
            raise TypeError(f"Criterion {name!r} must be a predicate, but its type is {kind}.")

    met = {name: boolean_or_false(F.col(name).cast("boolean")) for name in criteria}
    so_far = reduce(lambda passed, flag: passed + [passed[-1] & flag], met.values(), [F.lit(True)])
    columns = [met[c].alias(c) if c in met else F.col(c) for c in flagged.columns]
    columns += [passed.alias(step) for step, passed in zip(_steps(criteria), so_far)]
    return flagged.select(*columns, so_far[-1].alias("include"))


def inclusion_flowchart(
    flagged: DataFrame,
    criteria: Mapping[str, str],
    row_id_col: str = "row_id",
    person_id_col: str = "person_id",
) -> DataFrame:
    """Rows and distinct persons left after each criterion, and how many the criterion excluded.

    As steps are cumulative, a row is described by the last step it reached. One pass makes two histograms of these depths,
    of rows and of persons by their greatest one; what is shuffled is a person and a depth, combined map-side, whatever
    the number of criteria. Sums from a depth on give the chart; the difference to the step before needs no window over
    the data. Rows without a person id count as rows but not as persons.
    """
    _check_criteria(criteria)
    missing = [c for c in (row_id_col, person_id_col, *_steps(criteria)) if c not in flagged.columns]
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}.")

    steps = _steps(criteria)
    # steps are cumulative, so the last one reached says it all
    reached = F.coalesce(*[F.when(F.col(step), F.lit(i)) for i, step in reversed(list(enumerate(steps)))])
    narrow = flagged.select(F.col(person_id_col).alias("person"), reached.alias("reached")).withColumn("deepest", F.col("reached"))
    # one pass for both histograms: rows by depth, and the greatest depth of each person
    depths = narrow.groupingSets([[F.col("person")], [F.col("reached")]], "person", "reached").agg(
        (F.grouping("reached") == 1).alias("of_person"), F.max("deepest").alias("deepest"), F.count(F.lit(1)).alias("n")
    )
    # one row for each person and each depth by now; a missing person id is no person
    known = ~F.col("of_person") | F.col("person").isNotNull()
    number = F.when(F.col("of_person"), F.lit(1).cast("long")).otherwise(F.col("n"))

    def beyond(of_person: bool, i: int):
        return F.coalesce(F.sum(F.when(known & (F.col("of_person") == of_person) & (F.col("deepest") >= i), number)), F.lit(0).cast("long"))

    totals = depths.agg(
        *[beyond(False, i).alias(f"rows_{i}") for i in range(len(steps))],
        *[beyond(True, i).alias(f"ids_{i}") for i in range(len(steps))],
    )

    labels = [("Original table", ""), *criteria.items()]

    def line(i: int):
        def excluded(kind: str):
            if i == 0:
                return F.lit(None).cast("long")
            return F.col(f"{kind}_{i - 1}") - F.col(f"{kind}_{i}")

        return F.struct(
            F.lit(i).alias("criteria_index"),
            F.lit(steps[i]).alias("criteria"),
            F.lit(labels[i][0]).alias("description"),
            F.lit(labels[i][1]).alias("expression"),
            F.col(f"rows_{i}").alias("n_row"),
            F.col(f"ids_{i}").alias("n_distinct_id"),
            excluded("rows").alias("excluded_rows"),
            excluded("ids").alias("excluded_ids"),
        )

    return totals.select(F.inline(F.array(*map(line, range(len(steps))))))


def apply_inclusion_criteria(
    cohort: DataFrame,
    criteria: Mapping[str, str],
    flowchart_table: str | None = None,
    row_id_col: str = "row_id",
    person_id_col: str = "person_id",
    drop_inclusion_flags: bool = True,
    directory: Mapping | None = None,
) -> DataFrame:
    """Rows of the cohort that meet every criterion.

    With ``flowchart_table``, a key of the table directory, the flowchart is saved first; that job and the returned
    rows each compute the cohort, so pass a stored table rather than a long plan.
    """
    _check_criteria(criteria)
    _check_columns(cohort, criteria, row_id_col, person_id_col)
    flagged = flag_inclusion(cohort, criteria)
    if flowchart_table is not None:
        from recordloom.sources.tables import save_table

        save_table(inclusion_flowchart(flagged, criteria, row_id_col, person_id_col), flowchart_table, directory)
    included = flagged.filter("include")
    return included.select(*cohort.columns) if drop_inclusion_flags else included
