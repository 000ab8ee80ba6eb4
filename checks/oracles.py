"""Oracle SQL of the multi-source extracts and of record selection, written for the comparison engine."""

from __future__ import annotations

from recordloom.plans.selection import SEED
from recordloom.sources import codelist_values as values

SNOMED_ETHNICITY = [
    ("413773004", "Caucasian (racial group)", "C"),
    ("414752008", "Mixed racial group (racial group)", "G"),
    ("415226007", "Race not stated (racial group)", "Z"),
]
ICD10_INFECTION = [
    ("U071", "COVID-19, virus identified", "confirmed"),
    ("U072", "COVID-19, virus not identified", "suspected"),
]


def inline(rows: list[tuple], columns: str) -> str:
    """A list of text rows as a table expression."""
    lines = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"(select * from (values {lines}) t({columns}))"


def choose(column: str, mapping: dict, otherwise: str = "null") -> str:
    """A mapping as a case expression."""
    cases = " ".join(f"when '{k}' then " + ("null" if v is None else f"'{v}'") for k, v in mapping.items())
    return f"case {column} {cases} else {otherwise} end"


def _dob(view: str, date: str, born: str, source: str) -> str:
    return f"""select distinct person_id, cast({date} as date) as record_date, {born} as date_of_birth,
        '{source}' as data_source from {view}
        where person_id is not null and {date} is not null and {born} is not null"""


def _dob_age(view: str, date: str, age: str, source: str, completed: bool = False) -> str:
    years = "age + 0.5e0" if completed else "case when age < 1 then cast(age as double) else age + 0.5e0 end"
    return f"""select person_id, record_date,
        record_date - cast(round(({years}) * 365.25e0) as int) as date_of_birth, '{source}' as data_source
        from (select distinct person_id, cast({date} as date) as record_date, {age} as age from {view}
              where person_id is not null and {date} is not null and {age} is not null)"""


def _sex(view: str, date: str, code: str, codes: dict, source: str) -> str:
    return f"""select distinct person_id, cast({date} as date) as record_date, {code} as sex_code,
        {choose(code, codes, code)} as sex, '{source}' as data_source from {view}
        where person_id is not null and {date} is not null and {code} is not null"""


def _lsoa(view: str, date: str, code: str, source: str) -> str:
    return f"""select distinct person_id, cast({date} as date) as record_date, {code} as lsoa,
        '{source}' as data_source from {view}
        where person_id is not null and {date} is not null and {code} is not null"""


def _ethnicity(view: str, date: str, code: str, source: str, old_codes: bool = False) -> str:
    described = {**values.PRE_2003_DESCRIPTION, **values.CATEGORY_DESCRIPTION} if old_codes else None
    raw = choose("raw", described or values.CATEGORY_DESCRIPTION)
    category = choose("raw", values.PRE_2003_CATEGORY, "raw") if old_codes else "raw"
    return f"""select person_id, record_date, raw as ethnicity_raw_code, description as ethnicity_raw_description,
        category as ethnicity_18_code, {choose("category", values.CATEGORY_DESCRIPTION)} as ethnicity_18_group,
        {choose("category", values.CATEGORY_BROAD_GROUP)} as ethnicity_5_group, '{source}' as data_source
        from (select *, {raw} as description, {category} as category
              from (select distinct person_id, cast({date} as date) as record_date, {code} as raw from {view}
                    where person_id is not null and {date} is not null and {code} is not null))"""


_ETHNICITY_SNOMED = f"""select distinct person_id, record_date, code as ethnicity_raw_code,
    description as ethnicity_raw_description, ethnic_category as ethnicity_18_code,
    {choose("ethnic_category", values.CATEGORY_DESCRIPTION)} as ethnicity_18_group,
    {choose("ethnic_category", values.CATEGORY_BROAD_GROUP)} as ethnicity_5_group, 'gdppr_snomed' as data_source
    from (select person_id, code, case when record_date is null or record_date = date '{values.NO_DATE}'
                 then date else record_date end as record_date from v_gdppr)
    join {inline(SNOMED_ETHNICITY, "code, description, ethnic_category")} using (code)
    where person_id is not null and record_date is not null"""

_UNCODED = "cast(null as varchar) as code, cast(null as varchar) as description, 'confirmed' as covid_status"
_ICD10 = inline(ICD10_INFECTION, "code, description, covid_status")


def _diagnosis(source: str, where: str) -> str:
    return f"""select distinct person_id, epistart as date, code, description, covid_status, '{source}' as data_source
        from v_hes_apc_diagnosis join {_ICD10} using (code) where {where} and epistart is not null"""


EXTRACTS = {
    "date_of_birth": {
        "gdppr": _dob(
            "v_gdppr_demographics",
            "reporting_period_end_date",
            "cast(try_strptime(year_month_of_birth, '%Y-%m') as date)",
            "gdppr",
        ),
        "hes_apc": _dob("v_hes_apc", "epistart", "cast(try_strptime(mydob, '%m%Y') as date)", "hes_apc"),
        "hes_op": _dob_age("v_hes_op", "apptdate", "apptage_calc", "hes_op"),
        "hes_ae": _dob_age("v_hes_ae", "arrivaldate", "arrivalage_calc", "hes_ae"),
        "ssnap": _dob_age("v_ssnap", "s1firstarrivaldatetime", "s1ageonarrival", "ssnap", completed=True),
        "vaccine_status": _dob(
            "v_vaccine_status", "recorded_date", "cast(try_strptime(mydob, '%m%Y') as date)", "vaccine_status"
        ),
    },
    "sex": {
        "gdppr": _sex("v_gdppr_demographics", "reporting_period_end_date", "sex", values.SEX_GDPPR, "gdppr"),
        "hes_apc": _sex("v_hes_apc", "epistart", "sex", values.SEX_HES_APC, "hes_apc"),
        "hes_op": _sex("v_hes_op", "apptdate", "sex", values.SEX_HES_OP, "hes_op"),
        "hes_ae": _sex("v_hes_ae", "arrivaldate", "sex", values.SEX_HES_AE, "hes_ae"),
        "ssnap": _sex("v_ssnap", "s1firstarrivaldatetime", "s1gender", values.SEX_SSNAP, "ssnap"),
    },
    "ethnicity": {
        "gdppr_snomed": _ETHNICITY_SNOMED,
        "gdppr": _ethnicity("v_gdppr_demographics", "reporting_period_end_date", "ethnic", "gdppr"),
        "hes_apc": _ethnicity("v_hes_apc", "epistart", "ethnos", "hes_apc", old_codes=True),
        "hes_op": _ethnicity("v_hes_op", "apptdate", "ethnos", "hes_op"),
        "hes_ae": _ethnicity("v_hes_ae", "arrivaldate", "ethnos", "hes_ae"),
    },
    "lsoa": {
        "gdppr": _lsoa("v_gdppr_demographics", "reporting_period_end_date", "lsoa", "gdppr"),
        "hes_apc": _lsoa("v_hes_apc", "epistart", "lsoa11", "hes_apc"),
        "hes_op": _lsoa("v_hes_op", "apptdate", "lsoa11", "hes_op"),
        "hes_ae": _lsoa("v_hes_ae", "arrivaldate", "lsoa11", "hes_ae"),
        "vaccine_status": _lsoa("v_vaccine_status", "recorded_date", "lsoa", "vaccine_status"),
    },
    "covid_positive": {
        "sgss": f"""select distinct person_id, coalesce(specimen_date, lab_report_date) as date, {_UNCODED},
            'sgss' as data_source from v_sgss
            where person_id is not null and coalesce(specimen_date, lab_report_date) is not null""",
        "pillar_2": f"""select distinct person_id, date, code, description, 'confirmed' as covid_status,
            'pillar_2' as data_source
            from (select person_id, teststartdate as date, testresult,
                         nullif(regexp_extract(testresult, 'SCT:([0-9]+)', 1), '') as code from v_pillar_2)
            left join {inline(values.ANTIGEN_TESTS, "code, description, test_result")} using (code)
            where person_id is not null and date is not null and coalesce(test_result, testresult) = 'Positive'""",
        "gdppr": f"""select distinct person_id, date, code, description, covid_status, 'gdppr' as data_source
            from (select person_id, coalesce(date, record_date) as date, code from v_gdppr)
            join {inline(values.INFECTION_CODES, "code, description, covid_status")} using (code)
            where person_id is not null and date is not null""",
        "hes_apc_any_diagnosis": _diagnosis("hes_apc_any_diagnosis", "person_id is not null"),
        "hes_apc_primary_diagnosis": _diagnosis("hes_apc_primary_diagnosis", "diag_position = 1"),
        "chess": f"""select distinct person_id, hospitaladmissiondate as date, {_UNCODED}, 'chess' as data_source
            from v_chess where person_id is not null and hospitaladmissiondate is not null and covid19 = 'Yes'""",
    },
}

DATES = {"record_date", "date_of_birth", "date"}
COLUMNS = {
    "date_of_birth": ("person_id", "record_date", "date_of_birth", "data_source"),
    "sex": ("person_id", "record_date", "sex_code", "sex", "data_source"),
    "ethnicity": (
        "person_id",
        "record_date",
        "ethnicity_raw_code",
        "ethnicity_raw_description",
        "ethnicity_18_code",
        "ethnicity_18_group",
        "ethnicity_5_group",
        "data_source",
    ),
    "lsoa": ("person_id", "record_date", "lsoa", "data_source"),
    "covid_positive": ("person_id", "date", "code", "description", "covid_status", "data_source"),
}


def _shown(columns) -> str:
    return ", ".join(f"cast({c} as varchar) as {c}" if c in DATES else c for c in columns)


def long_table(asset: str, sources: list[str] | None = None) -> str:
    """All extracts of an asset put together, columns typed."""
    parts = [EXTRACTS[asset][s] for s in (sources or EXTRACTS[asset])]
    return "\nunion all\n".join(f"select {', '.join(COLUMNS[asset])} from ({p})" for p in parts)


def multisource_sql(asset: str, sources: list[str] | None = None) -> str:
    return f"select {_shown(COLUMNS[asset])} from ({long_table(asset, sources)})"


def selection_sql(
    rows: str,
    values: list[str],
    ties: list[tuple[str, str, dict]],
    where: str,
    priority: dict | None,
    tie_order: list[str],
    recency_first: bool = False,
) -> str:
    """One record per person from a long table.

    ``ties`` holds (value, flag, {list column: value}) per tie group.
    """
    rank = "cast(null as int)"
    if priority:
        rank = "case data_source " + " ".join(f"when '{s}' then {n}" for s, n in priority.items()) + " end"
    order = ["source_priority asc nulls last", "record_date desc"]
    order = ", ".join(order[::-1] if recency_first else order)
    text = ", ".join(f"cast({v} as varchar)" for v in values)
    listing = ", ".join(f"{v} nulls first" for v in ["data_source", *tie_order])
    collected, lists = [], []
    for value, flag, columns in ties:
        collected.append(f"case when count(distinct {value}) > 1 then cast(1 as int) end as {flag}")
        for name, column in columns.items():
            collected.append(f"string_agg(cast({column} as varchar), ',' order by {listing}) as {name}")
            lists.append(f"case when {flag} = 1 then coalesce({name}, '') end as {name}")
    flags = [flag for _, flag, _ in ties]
    return f"""with long_rows as ({rows}),
    ranked as (select *, dense_rank() over (partition by person_id order by {order}) as best
               from (select *, {rank} as source_priority from long_rows where {where})),
    tied as (select *, md5(concat_ws('|', '{SEED}', person_id, data_source, {text})) as number
             from ranked where best = 1),
    picked as (select * from tied qualify row_number() over (
               partition by person_id order by number, data_source, {', '.join(values)}) = 1),
    collected as (select person_id, {', '.join(collected)} from tied group by person_id)
    select person_id, {_shown([*values, 'record_date', 'data_source'])}, {', '.join([*flags, *lists])}
    from picked join collected using (person_id)"""
