"""One record per person from a long multi-source table, every tie reported."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions import seeded_order
from recordloom.operators.filters import exclude_codes, filter_sources, require, within_dates
from recordloom.operators.hot_keys import dealt, has_key, hot_keys
from recordloom.sources.codelist_values import ETHNICITY_NULL_CODES

SEED = 124910

_DEFAULT = object()


@dataclass(frozen=True)
class TieGroup:
    """One notion of a tie: more than one distinct value of ``value`` among the best records.

    ``lists`` names the output arrays and the value each one lists.
    """

    value: str
    flag: str
    lists: Mapping[str, str]


@dataclass(frozen=True)
class SelectionSpec:
    """How one record per person is chosen for an asset."""

    # Value columns of the multi-source table, in output order.
    values: tuple[str, ...]
    ties: tuple[TieGroup, ...]
    # Output columns in order.
    output: tuple[str, ...]
    sources: tuple[str, ...]
    priority: Mapping[str, int]
    # Value columns that order the tie arrays after the data source; the others follow.
    tie_order: tuple[str, ...]
    # Value columns that must be known.
    required: tuple[str, ...]
    # Default inclusive bounds by date column.
    bounds: Mapping[str, tuple[str | None, str | None]] = field(
        default_factory=lambda: {"record_date": ("1900-01-01", "current_date()")}
    )
    # Codes that count as unknown, by column.
    null_codes: Mapping[str, Collection[str]] = field(default_factory=dict)
    condition: str | None = None
    # Latest date first and priority second, instead of the reverse.
    recency_first: bool = False


def _check_priority(priority: Mapping[str, int] | None, sources: Sequence[str]) -> None:
    if priority is None:
        return
    if not all(isinstance(rank, int) and not isinstance(rank, bool) for rank in priority.values()):
        raise ValueError("Priorities must be integers.")
    unknown = [source for source in priority if source not in sources]
    if unknown:
        raise ValueError(f"Unknown data sources in priority_index {unknown}; allowed are {sorted(sources)}.")


def _standing(spec: SelectionSpec, priority: Mapping[str, int] | None) -> Column:
    """Priority and recency as one number, the better the lower; sources without a priority come last."""
    ranks = sorted(set((priority or {}).values()))
    rank = F.lit(len(ranks))
    for source, level in (priority or {}).items():
        rank = F.when(F.col("data_source") == source, ranks.index(level)).otherwise(rank)
    age = -F.unix_date("record_date").cast("long")
    # Days need 32 bits with their sign, so neither part reaches into the other.
    return age * (len(ranks) + 1) + rank if spec.recency_first else rank.cast("long") * 2**33 + age


def _best_rows(
    rows: DataFrame, spec: SelectionSpec, priority: Mapping[str, int] | None, persons: DataFrame | None = None
) -> DataFrame:
    """Each person's best rows, with the number of equal ones in ``copies``.

    One scan and one shuffle. Of a small input every task cuts its persons to their best rows first; a larger one is dealt by
    person as it is, to tasks whose number grows with it, and sorted there once. Where a person holds so many rows that these
    could be too many for a task, the rows of such persons are counted by their whole content instead, which combines equal ones
    map-side and spreads the others, and the distinct ones are cut by every task and ranked: a shuffle more, for these persons
    only.
    """
    needed = rows.select("person_id", "record_date", "data_source", *spec.values)
    person = Window.partitionBy("person_id").orderBy("standing")

    def best(of: DataFrame) -> DataFrame:
        # What can be worked out after the shuffle is not shuffled.
        ranked = of.withColumn("standing", _standing(spec, priority)).withColumn("place", F.rank().over(person))
        return ranked.filter("place = 1").drop("place", "standing")

    def single(of: DataFrame) -> DataFrame:
        return best(dealt(of, ["person_id"])).withColumn("copies", F.lit(1))

    hot = hot_keys(needed if persons is None else persons, ["person_id"])
    if not hot:
        return single(needed)
    is_hot = has_key(["person_id"], hot)
    counted = needed.filter(is_hot).groupBy(*needed.columns).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return single(needed.filter(~is_hot)).unionByName(best(counted))


def select_records(
    df: DataFrame,
    spec: SelectionSpec,
    bounds: Mapping[str, tuple] | None = None,
    filter_data_sources: list[str] | None = None,
    priority_index: Mapping[str, int] | None = _DEFAULT,
    null_codes: Mapping[str, Collection[str]] | None = None,
    seed: int = SEED,
    persons: DataFrame | None = None,
) -> DataFrame:
    """One record per person: best source priority, then latest date (or the reverse), ties reported.

    Usable rows are those with known values, a date within the bounds and an admitted source. Among a person's best
    rows (the same priority and date) one is picked by a seeded hash of its values, which does not depend on how the
    data are partitioned. If they hold more than one distinct known value, the tie flag is 1 and the arrays list all
    of them with their sources, ordered by source and values, repeated as often as they occur; otherwise flag and
    arrays are null. Sources without a priority come last; ``priority_index=None`` gives all sources the same.

    Nothing is assumed about equal rows or about how many rows a person has; see ``_best_rows``. A reported tie writes its
    equal rows out, so its arrays are as long as the tie.

    Persons with very many rows are looked for in a pass over the person ids before the plan is made. If ``df`` is not a stored
    table this pass works out all that it takes; ``persons`` then names the rows to look at instead, such as those of
    ``source_persons``: any with a ``person_id``, as many or more a person than in ``df``. It never decides on a result.
    """
    priority = spec.priority if priority_index is _DEFAULT else priority_index
    _check_priority(priority, spec.sources)
    usable = require(df, ["person_id", "record_date", *spec.required])
    if spec.condition is not None:
        usable = usable.filter(spec.condition)
    for column, codes in {**spec.null_codes, **(null_codes or {})}.items():
        usable = exclude_codes(usable, column, codes)
    for column, (minimum, maximum) in {**spec.bounds, **(bounds or {})}.items():
        usable = within_dates(usable, column, minimum, maximum)
    usable = filter_sources(usable, filter_data_sources, spec.sources)

    best = _best_rows(usable, spec, priority, persons)

    # Over a person's best rows: how many there are, and whether each tie holds more than one known value. Only persons
    # with a tie to report have their rows gathered.
    whole = Window.partitionBy("person_id")
    flags = {t.flag: F.min(t.value).over(whole) != F.max(t.value).over(whole) for t in spec.ties}
    flagged = best.withColumns({**flags, "lone": F.count(F.lit(1)).over(whole) == 1})

    # Struct order is list order: source, then the ordering values, then the rest.
    record = F.struct("data_source", *spec.tie_order, *[v for v in spec.values if v not in spec.tie_order], "record_date")
    number = seeded_order(seed, F.col("person_id"), F.col("data_source"), *[F.col(v) for v in spec.values])
    drawn = F.struct(F.when(~F.col("lone"), number).alias("number"), record.alias("record"))
    any_tie = reduce(lambda a, b: a | b, [F.coalesce(F.col(t.flag), F.lit(False)) for t in spec.ties])
    picked = flagged.groupBy("person_id").agg(
        F.min(drawn)["record"].alias("pick"),
        *[F.when(F.max(t.flag), F.lit(1)).alias(t.flag) for t in spec.ties],
        F.sort_array(F.collect_list(F.when(any_tie, F.struct(record.alias("record"), "copies")))).alias("tied"),
    )

    def listed(column: str) -> Column:
        repeated = F.transform("tied", lambda entry: F.array_repeat(entry["record"][column], entry["copies"]))
        return F.array_compact(F.flatten(repeated))

    lists = {name: F.when(F.col(t.flag) == 1, listed(column)) for t in spec.ties for name, column in t.lists.items()}
    chosen = {name: F.col("pick")[name] for name in ("data_source", "record_date", *spec.values)}
    made = {**chosen, **lists}
    return picked.select(*[made[name].alias(name) if name in made else F.col(name) for name in spec.output])


_PRIORITY = {"gdppr": 1, "hes_apc": 2, "hes_op": 3, "hes_ae": 3}

DATE_OF_BIRTH = SelectionSpec(
    values=("date_of_birth",),
    ties=(
        TieGroup(
            "date_of_birth",
            "date_of_birth_tie_flag",
            {"date_of_birth_tie_value": "date_of_birth", "date_of_birth_tie_data_source": "data_source"},
        ),
    ),
    output=(
        "person_id",
        "date_of_birth",
        "record_date",
        "data_source",
        "date_of_birth_tie_flag",
        "date_of_birth_tie_value",
        "date_of_birth_tie_data_source",
    ),
    sources=("gdppr", "hes_apc", "hes_op", "hes_ae", "ssnap", "vaccine_status"),
    priority=_PRIORITY,
    tie_order=("date_of_birth",),
    required=("date_of_birth",),
    bounds={"record_date": ("1900-01-01", "current_date()"), "date_of_birth": ("1880-01-01", "current_date()")},
    condition="record_date >= date_of_birth",
)

SEX = SelectionSpec(
    values=("sex_code", "sex"),
    ties=(
        TieGroup(
            "sex",
            "sex_tie_flag",
            {"sex_code_tie_value": "sex_code", "sex_tie_value": "sex", "sex_tie_data_source": "data_source"},
        ),
    ),
    output=(
        "person_id",
        "sex_code",
        "sex",
        "record_date",
        "data_source",
        "sex_tie_flag",
        "sex_code_tie_value",
        "sex_tie_value",
        "sex_tie_data_source",
    ),
    sources=("gdppr", "hes_apc", "hes_op", "hes_ae", "ssnap"),
    priority=_PRIORITY,
    tie_order=("sex_code", "sex"),
    required=("sex",),
)

ETHNICITY = SelectionSpec(
    values=(
        "ethnicity_raw_code",
        "ethnicity_raw_description",
        "ethnicity_18_code",
        "ethnicity_18_group",
        "ethnicity_5_group",
    ),
    ties=tuple(
        TieGroup(
            f"ethnicity_{n}_group",
            f"ethnicity_{n}_tie_flag",
            {
                f"ethnicity_{n}_tie_group": f"ethnicity_{n}_group",
                f"ethnicity_{n}_tie_data_source": "data_source",
            },
        )
        for n in (5, 18)
    ),
    output=(
        "person_id",
        "ethnicity_raw_code",
        "ethnicity_raw_description",
        "ethnicity_18_code",
        "ethnicity_18_group",
        "ethnicity_5_group",
        "record_date",
        "data_source",
        "ethnicity_5_tie_flag",
        "ethnicity_5_tie_group",
        "ethnicity_5_tie_data_source",
        "ethnicity_18_tie_flag",
        "ethnicity_18_tie_group",
        "ethnicity_18_tie_data_source",
    ),
    sources=("gdppr_snomed", "gdppr", "hes_apc", "hes_op", "hes_ae"),
    priority={"gdppr_snomed": 1, "gdppr": 2, "hes_apc": 3, "hes_op": 4, "hes_ae": 4},
    tie_order=("ethnicity_18_code", "ethnicity_18_group", "ethnicity_5_group"),
    required=("ethnicity_raw_code",),
    null_codes={"ethnicity_18_code": ETHNICITY_NULL_CODES},
)

LSOA = SelectionSpec(
    values=("lsoa",),
    ties=(TieGroup("lsoa", "lsoa_tie_flag", {"lsoa_tie_value": "lsoa", "lsoa_tie_data_source": "data_source"}),),
    output=(
        "person_id",
        "lsoa",
        "record_date",
        "data_source",
        "lsoa_tie_flag",
        "lsoa_tie_value",
        "lsoa_tie_data_source",
    ),
    sources=("gdppr", "hes_apc", "hes_op", "hes_ae", "vaccine_status"),
    priority=_PRIORITY,
    tie_order=("lsoa",),
    required=("lsoa",),
    recency_first=True,
)

SELECTIONS = {"date_of_birth": DATE_OF_BIRTH, "sex": SEX, "ethnicity": ETHNICITY, "lsoa": LSOA}


def select_date_of_birth(
    df: DataFrame,
    min_record_date="1900-01-01",
    max_record_date="current_date()",
    min_date_of_birth="1880-01-01",
    max_date_of_birth="current_date()",
    **options,
) -> DataFrame:
    """Date of birth per person: priority, then recency; records dated before the birth are ignored."""
    bounds = {
        "record_date": (min_record_date, max_record_date),
        "date_of_birth": (min_date_of_birth, max_date_of_birth),
    }
    return select_records(df, DATE_OF_BIRTH, bounds, **options)


def select_sex(
    df: DataFrame, min_record_date="1900-01-01", max_record_date="current_date()", **options
) -> DataFrame:
    """Sex per person: priority, then recency."""
    return select_records(df, SEX, {"record_date": (min_record_date, max_record_date)}, **options)


def select_ethnicity(
    df: DataFrame,
    min_record_date="1900-01-01",
    max_record_date="current_date()",
    ethnicity_18_null_codes: Collection[str] = tuple(ETHNICITY_NULL_CODES),
    **options,
) -> DataFrame:
    """Ethnicity per person: priority, then recency; ties of the 5 and the 18 categories are reported separately."""
    bounds = {"record_date": (min_record_date, max_record_date)}
    return select_records(df, ETHNICITY, bounds, null_codes={"ethnicity_18_code": ethnicity_18_null_codes}, **options)


def select_lsoa(
    df: DataFrame, min_record_date="1900-01-01", max_record_date="current_date()", **options
) -> DataFrame:
    """Small-area geography per person: recency, then priority."""
    return select_records(df, LSOA, {"record_date": (min_record_date, max_record_date)}, **options)
