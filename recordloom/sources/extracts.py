"""Extraction of one attribute from several sources into one long table.

A source is declared, not programmed: which table, which SQL expressions, what must be known, what is derived after
the distinct. The extracts of an asset share a declared schema and are put together by name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import dob_from_age, lookup, recoded
from recordloom.operators.codelists import fits_broadcast, match_codelist
from recordloom.operators.filters import require
from recordloom.operators.hot_keys import distinct_rows
from recordloom.sources import codelist_values as values


@dataclass(frozen=True)
class SourceSpec:
    """How one source feeds an asset."""

    table: str
    # Output column to SQL text over the loaded table; the person id is taken along.
    columns: Mapping[str, str]
    # Standardisation to load the table with.
    method: str | None = None
    # Predicate over the columns (and an optional codelist) that rows must meet.
    where: str | None = None
    # Codelist joined on ``code``: 'listed' keeps listed codes only, 'optional' attaches it where it matches.
    codelist: str | None = None
    codelist_use: str = "listed"
    # Columns that go through the distinct, where not all of them do.
    keep: tuple[str, ...] | None = None
    # Columns that may be null; all others must be known.
    nullable: tuple[str, ...] = ()
    # Column to a function of the source row giving the derived column, applied in order after the distinct.
    derive: Mapping[str, Callable[[], F.Column]] = field(default_factory=dict)

    @property
    def kept(self) -> list[str]:
        return list(self.keep if self.keep is not None else self.columns)


@dataclass(frozen=True)
class Asset:
    """A multi-source table: its schema and the sources that feed it, by data source name."""

    name: str
    schema: T.StructType
    sources: Mapping[str, SourceSpec]

    def with_source(self, name: str, spec: SourceSpec) -> Asset:
        """The asset with one more source, or with another definition of one."""
        return replace(self, sources={**self.sources, name: spec})

    def chosen(self, methods: Sequence[str] | None) -> list[str]:
        """The requested sources, all by default."""
        methods = list(self.sources) if methods is None else list(methods)
        unknown = [m for m in methods if m not in self.sources]
        if unknown or not methods:
            raise ValueError(f"Invalid extract methods {unknown}; allowed are {', '.join(self.sources)}.")
        return methods


@dataclass(frozen=True)
class Codelist:
    """A codelist together with the knowledge whether it may be broadcast."""

    rows: DataFrame
    small: bool

    @classmethod
    def checked(cls, rows: DataFrame) -> Codelist:
        return cls(rows, fits_broadcast(rows))

    def of(self, name: str) -> DataFrame:
        """Its distinct rows, without columns that the sources do not use, which could repeat codes."""
        used = CODELIST_COLUMNS.get(name)
        return (self.rows if used is None else self.rows.select(*used)).distinct()


# The columns of a codelist that the sources here use; other codelists are taken with all their columns.
CODELIST_COLUMNS = {
    "ethnicity_snomed": ("code", "description", "ethnic_category"),
    "infection_icd10": ("code", "description", "covid_status"),
    "infection_snomed": ("code", "description", "covid_status"),
    "antigen_tests": ("code", "description", "test_result"),
}


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def extract(
    df: DataFrame,
    asset: Asset,
    labels: str | Sequence[str],
    codelists: Mapping[str, DataFrame | Codelist] | None = None,
) -> DataFrame:
    """Rows of one loaded table for an asset, distinct and tagged with the data source.

    Only the needed columns are read and unusable rows are dropped at the scan. The shuffle of the distinct is keyed by the
    whole row and therefore spreads a frequent person; see ``distinct_rows`` for rows that are repeated.
    A codelist filters before the distinct but its texts are attached after it, so they are not shuffled.

    Several labels that differ in their predicate only are served by one scan.
    """
    labels = [labels] if isinstance(labels, str) else list(labels)
    specs = [asset.sources[asset.chosen([label])[0]] for label in labels]
    spec = specs[0]
    listed = spec.codelist is not None and spec.codelist_use == "listed"

    rows = df.select("person_id", *[F.expr(sql).alias(name) for name, sql in spec.columns.items()])
    if spec.codelist is not None:
        if spec.codelist not in (codelists or {}):
            raise ValueError(f"Source {labels[0]!r} needs the codelist {spec.codelist!r}.")
        codes = codelists[spec.codelist]
        codes = codes if isinstance(codes, Codelist) else Codelist.checked(codes)
        if listed:
            rows = match_codelist(rows, codes.rows.select("code"), how="left_semi", small=codes.small)
        else:
            rows = match_codelist(rows, codes.of(spec.codelist), how="left", small=codes.small)

    rows = require(rows, ["person_id", *[c for c in spec.kept if c not in spec.nullable]])
    if len(specs) == 1:
        rows = rows if spec.where is None else rows.filter(spec.where)
        rows = distinct_rows(rows.select("person_id", *spec.kept)).withColumn("data_source", F.lit(labels[0]))
    else:
        met = [F.lit(l) if s.where is None else F.when(F.expr(s.where), l) for l, s in zip(labels, specs)]
        tags = F.explode(F.array_compact(F.array(*met))).alias("data_source")
        rows = distinct_rows(rows.select("person_id", *spec.kept, tags))

    if listed:
        rows = match_codelist(rows, codes.of(spec.codelist), how="inner", small=codes.small)
    for name, column in spec.derive.items():
        rows = rows.withColumn(name, column())
    return _conform(rows, asset.schema)


def combine_sources(extracts: Sequence[DataFrame]) -> DataFrame:
    """All rows of the extracts, matched by column name."""
    return reduce(DataFrame.unionByName, extracts)


def scans(asset: Asset, methods: Sequence[str] | None = None) -> list[list[str]]:
    """The requested sources grouped by the scan that serves them: those that differ in the predicate only share one."""
    groups: list[list[str]] = []
    for method in asset.chosen(methods):
        spec = replace(asset.sources[method], where=None)
        same = next((g for g in groups if replace(asset.sources[g[0]], where=None) == spec and method not in g), None)
        if same is None:
            groups.append([method])
        else:
            same.append(method)
    return groups


def _schema(text: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, T.DateType() if kind == "date" else T.StringType())
            for name, kind in (column.split() for column in text.split(", "))
        ]
    )


def _date(column: str) -> str:
    return f"try_cast({column} as date)"


# Date of birth -----------------------------------------------------------------------------------------------------


def _born_at_age(completed_years: bool = False) -> dict:
    return {"date_of_birth": lambda: dob_from_age(F.col("record_date"), F.col("age"), completed_years)}


def _month_of_birth(date: str, born: str) -> dict:
    return {"record_date": _date(date), "date_of_birth": born}


DATE_OF_BIRTH = Asset(
    "date_of_birth",
    _schema("person_id string, record_date date, date_of_birth date, data_source string"),
    {
        "gdppr": SourceSpec(
            "gdppr_demographics",
            _month_of_birth("reporting_period_end_date", "try_to_date(year_month_of_birth, 'yyyy-MM')"),
        ),
        "hes_apc": SourceSpec(
            "hes_apc", _month_of_birth("epistart", "try_to_date(mydob, 'MMyyyy')"), method="hes_apc"
        ),
        "hes_op": SourceSpec(
            "hes_op",
            {"record_date": _date("apptdate"), "age": "apptage_calc"},
            method="hes_op",
            derive=_born_at_age(),
        ),
        "hes_ae": SourceSpec(
            "hes_ae",
            {"record_date": _date("arrivaldate"), "age": "arrivalage_calc"},
            method="hes_ae",
            derive=_born_at_age(),
        ),
        "ssnap": SourceSpec(
            "ssnap",
            {"record_date": _date("s1firstarrivaldatetime"), "age": "s1ageonarrival"},
            method="ssnap",
            derive=_born_at_age(completed_years=True),
        ),
        "vaccine_status": SourceSpec(
            "vaccine_status",
            _month_of_birth(
                "recorded_date", "case when mydob rlike '^[0-9]{6}$' then try_to_date(mydob, 'MMyyyy') end"
            ),
            method="vaccine_status",
        ),
    },
)

# Sex ---------------------------------------------------------------------------------------------------------------


def _sex(table: str, date: str, code: str, codes: Mapping, method: str | None = None) -> SourceSpec:
    return SourceSpec(
        table,
        {"record_date": _date(date), "sex_code": code},
        method=method,
        derive={"sex": lambda: recoded(F.col("sex_code"), codes)},
    )


SEX = Asset(
    "sex",
    _schema("person_id string, record_date date, sex_code string, sex string, data_source string"),
    {
        "gdppr": _sex("gdppr_demographics", "reporting_period_end_date", "sex", values.SEX_GDPPR),
        "hes_apc": _sex("hes_apc", "epistart", "sex", values.SEX_HES_APC, "hes_apc"),
        "hes_op": _sex("hes_op", "apptdate", "sex", values.SEX_HES_OP, "hes_op"),
        "hes_ae": _sex("hes_ae", "arrivaldate", "sex", values.SEX_HES_AE, "hes_ae"),
        "ssnap": _sex("ssnap", "s1firstarrivaldatetime", "s1gender", values.SEX_SSNAP, "ssnap"),
    },
)

# Ethnicity ---------------------------------------------------------------------------------------------------------


def _groups(descriptions: Mapping | None, category: Callable[[], F.Column]) -> dict:
    """Raw description (unless the codelist brings it), 18-category code and group, 5-category group."""
    derived = {}
    if descriptions is not None:
        derived["ethnicity_raw_description"] = lambda: lookup(F.col("ethnicity_raw_code"), descriptions)
    derived["ethnicity_18_code"] = category
    derived["ethnicity_18_group"] = lambda: lookup(F.col("ethnicity_18_code"), values.CATEGORY_DESCRIPTION)
    derived["ethnicity_5_group"] = lambda: lookup(F.col("ethnicity_18_code"), values.CATEGORY_BROAD_GROUP)
    return derived


def _ethnicity(table: str, date: str, code: str, method: str | None = None) -> SourceSpec:
    return SourceSpec(
        table,
        {"record_date": _date(date), "ethnicity_raw_code": code},
        method=method,
        derive=_groups(values.CATEGORY_DESCRIPTION, lambda: F.col("ethnicity_raw_code")),
    )


ETHNICITY = Asset(
    "ethnicity",
    _schema(
        "person_id string, record_date date, ethnicity_raw_code string, ethnicity_raw_description string, "
        "ethnicity_18_code string, ethnicity_18_group string, ethnicity_5_group string, data_source string"
    ),
    {
        "gdppr_snomed": SourceSpec(
            "gdppr",
            {
                "record_date": f"coalesce(nullif({_date('record_date')}, date '{values.NO_DATE}'), {_date('date')})",
                "code": "code",
            },
            method="gdppr",
            codelist="ethnicity_snomed",
            derive={
                "ethnicity_raw_code": lambda: F.col("code"),
                "ethnicity_raw_description": lambda: F.col("description"),
                **_groups(None, lambda: F.col("ethnic_category")),
            },
        ),
        "gdppr": _ethnicity("gdppr_demographics", "reporting_period_end_date", "ethnic"),
        "hes_apc": replace(
            _ethnicity("hes_apc", "epistart", "ethnos", "hes_apc"),
            derive=_groups(
                {**values.PRE_2003_DESCRIPTION, **values.CATEGORY_DESCRIPTION},
                lambda: recoded(F.col("ethnicity_raw_code"), values.PRE_2003_CATEGORY),
            ),
        ),
        "hes_op": _ethnicity("hes_op", "apptdate", "ethnos", "hes_op"),
        "hes_ae": _ethnicity("hes_ae", "arrivaldate", "ethnos", "hes_ae"),
    },
)

# Small-area geography ----------------------------------------------------------------------------------------------


def _lsoa(table: str, date: str, code: str, method: str | None = None) -> SourceSpec:
    return SourceSpec(table, {"record_date": _date(date), "lsoa": code}, method=method)


LSOA = Asset(
    "lsoa",
    _schema("person_id string, record_date date, lsoa string, data_source string"),
    {
        "gdppr": _lsoa("gdppr_demographics", "reporting_period_end_date", "lsoa"),
        "hes_apc": _lsoa("hes_apc", "epistart", "lsoa11", "hes_apc"),
        "hes_op": _lsoa("hes_op", "apptdate", "lsoa11", "hes_op"),
        "hes_ae": _lsoa("hes_ae", "arrivaldate", "lsoa11", "hes_ae"),
        "vaccine_status": _lsoa("vaccine_status", "recorded_date", "lsoa", "vaccine_status"),
    },
)

# Positive COVID-19 records -----------------------------------------------------------------------------------------

_NO_CODE = {
    "code": lambda: F.lit(None).cast("string"),
    "description": lambda: F.lit(None).cast("string"),
    "covid_status": lambda: F.lit("confirmed"),
}
# Episodes with the diagnosis in any position; a primary diagnosis is reported under both labels.
_ANY_DIAGNOSIS = SourceSpec(
    "hes_apc_diagnosis",
    {"date": _date("epistart"), "code": "code", "diag_position": "diag_position"},
    codelist="infection_icd10",
    keep=("date", "code"),
)

COVID_POSITIVE = Asset(
    "covid_positive",
    _schema(
        "person_id string, date date, code string, description string, covid_status string, data_source string"
    ),
    {
        "sgss": SourceSpec(
            "sgss",
            {"date": f"coalesce({_date('specimen_date')}, {_date('lab_report_date')})"},
            method="sgss",
            derive=_NO_CODE,
        ),
        "pillar_2": SourceSpec(
            "pillar_2",
            {
                "date": _date("teststartdate"),
                "result_text": "testresult",
                "code": "nullif(regexp_extract(testresult, 'SCT:([0-9]+)', 1), '')",
            },
            method="pillar_2",
            codelist="antigen_tests",
            codelist_use="optional",
            where="coalesce(test_result, result_text) = 'Positive'",
            keep=("date", "code", "description"),
            nullable=("code", "description"),
            derive={"covid_status": lambda: F.lit("confirmed")},
        ),
        "gdppr": SourceSpec(
            "gdppr",
            {"date": f"coalesce({_date('date')}, {_date('record_date')})", "code": "code"},
            method="gdppr",
            codelist="infection_snomed",
        ),
        "hes_apc_any_diagnosis": _ANY_DIAGNOSIS,
        "hes_apc_primary_diagnosis": replace(_ANY_DIAGNOSIS, where="diag_position = 1"),
        "chess": SourceSpec(
            "chess",
            {"date": _date("hospitaladmissiondate"), "covid19": "covid19"},
            method="chess",
            where="covid19 = 'Yes'",
            keep=("date",),
            derive=_NO_CODE,
        ),
    },
)

ASSETS = {asset.name: asset for asset in (DATE_OF_BIRTH, SEX, ETHNICITY, LSOA, COVID_POSITIVE)}
