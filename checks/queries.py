"""Every registered query with its oracle: one Spark callable and one SQL text per name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import recordloom as rl
from checks import oracles as o
from checks.views import rendered, table, view, with_views
from recordloom.functions import date_bound, dob_from_age
from recordloom.sources import ASSETS, packaged_codelist
from recordloom.sources import codelist_values as values
from recordloom.sources.extracts import Codelist, scans

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, its result rendered as plain values, with its oracle."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rendered(function(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return function

    return register


def scratch(spark: SparkSession) -> str:
    """A new folder in the session's checkpoint folder or, where none is set, beside its warehouse: never on a machine of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.checkpoint.location", None)
    shared = shared or spark.sparkContext.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/recordloom-{uuid.uuid4().hex}"


# The scratch database of each query's last run, dropped when the query runs again.
_LAST_DATABASE: dict[str, str] = {}


def scratch_database(spark: SparkSession, of: str) -> str:
    """A new database for the tables that a query saves; the result is read from it later, so it outlives the call."""
    if of in _LAST_DATABASE:
        spark.sql(f"DROP DATABASE IF EXISTS {_LAST_DATABASE.pop(of)} CASCADE")
    name = _LAST_DATABASE[of] = f"recordloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark)}/{name}'")
    return name


def entries(database: str, *keys: str) -> dict:
    return {key: {"database": database, "table_name": key} for key in keys}


# Top rows ------------------------------------------------------------------------------------------------------------

_ORDERS = "o_orderkey, o_custkey, o_totalprice"
_MONTHS = "cast(date_trunc('month', o_orderdate) as date)"


def _orders_by_month(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey", f"{_MONTHS} as month")


@query(
    "first_row_per_person",
    f"""select {_ORDERS} from orders
        qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) <= 2""",
)
def first_row_per_person(spark, sf):
    orders = table(spark, sf, "orders").select(*_ORDERS.split(", "))
    return rl.first_row(orders, 2, "o_custkey", [F.col("o_totalprice").desc(), "o_orderkey"])


@query(
    "first_rank_per_person",
    f"""select o_orderkey, o_custkey, cast(month as varchar) as month, rank_index from (
            select o_orderkey, o_custkey, {_MONTHS} as month,
                   cast(rank() over (partition by o_custkey order by {_MONTHS}) as int) as rank_index from orders)
        where rank_index <= 3""",
)
def first_rank_per_person(spark, sf):
    return rl.first_rank(_orders_by_month(spark, sf), 3, "o_custkey", "month", return_index_column=True)


_DENSE = f"""select o_orderkey, o_custkey, cast(month as varchar) as month, dense_rank_index from (
            select o_orderkey, o_custkey, {_MONTHS} as month,
                   cast(dense_rank() over (partition by o_custkey order by {_MONTHS} desc) as int) as dense_rank_index
            from orders)
        where dense_rank_index <= 2"""


@query("first_dense_rank_per_person", _DENSE)
def first_dense_rank_per_person(spark, sf):
    months = _orders_by_month(spark, sf)
    return rl.first_dense_rank(months, 2, "o_custkey", "month desc", return_index_column=True)


@query("first_dense_rank_heavy_ties", _DENSE)
def first_dense_rank_heavy_ties(spark, sf):
    months = _orders_by_month(spark, sf)
    return rl.first_dense_rank(months, 2, "o_custkey", "month desc", return_index_column=True, heavy_ties=True)


@query(
    "first_rank_heavy_ties",
    """select o_orderkey, o_orderstatus, o_orderpriority, rank_index from (
           select *, cast(rank() over (partition by o_orderstatus order by o_orderpriority) as int) as rank_index
           from orders) where rank_index <= 3""",
)
def first_rank_heavy_ties(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return rl.first_rank(orders, 3, "o_orderstatus", "o_orderpriority", return_index_column=True, heavy_ties=True)


@query(
    "top_rows_nulls_last",
    """select person_id, sex, reporting_period_end_date::varchar as reporting_period_end_date from v_gdppr_demographics
       where person_id is not null
       qualify dense_rank() over (partition by person_id order by sex asc nulls last, reporting_period_end_date desc) <= 1""",
)
def top_rows_nulls_last(spark, sf):
    rows = view(spark, sf, "gdppr_demographics").select("person_id", "sex", "reporting_period_end_date")
    order = [F.col("sex").asc_nulls_last(), F.col("reporting_period_end_date").desc()]
    return rl.top_rows(rl.require(rows, ["person_id"]), "dense_rank", 1, ["person_id"], order)


@query(
    "top_rows_global",
    f"""select {_ORDERS}, cast(row_number() over (order by o_totalprice desc, o_orderkey) as int) as row_index
        from orders order by o_totalprice desc, o_orderkey limit 25""",
)
def top_rows_global(spark, sf):
    orders = table(spark, sf, "orders").select(*_ORDERS.split(", "))
    order = ["o_totalprice desc", "o_orderkey"]
    return rl.top_rows(orders, "row_number", 25, order_by=order, return_index_column=True)


@query(
    "top_rank_global",
    f"""select o_orderkey, o_custkey, cast(month as varchar) as month, rank_index from (
            select o_orderkey, o_custkey, {_MONTHS} as month,
                   cast(rank() over (order by {_MONTHS} desc) as int) as rank_index from orders)
        where rank_index <= 100""",
)
def top_rank_global(spark, sf):
    order = F.col("month").desc()
    return rl.first_rank(_orders_by_month(spark, sf), 100, order_by=order, return_index_column=True)


@query(
    "top_dense_rank_global",
    f"""select o_orderkey, o_custkey, cast(month as varchar) as month, dense_rank_index from (
            select o_orderkey, o_custkey, {_MONTHS} as month,
                   cast(dense_rank() over (order by {_MONTHS}) as int) as dense_rank_index from orders)
        where dense_rank_index <= 3""",
)
def top_dense_rank_global(spark, sf):
    return rl.first_dense_rank(_orders_by_month(spark, sf), 3, order_by="month", return_index_column=True)


@query(
    "top_rank_global_computed_key",
    f"""select o_orderkey, o_custkey, cast(month as varchar) as month, rank_index from (
            select o_orderkey, o_custkey, {_MONTHS} as month,
                   cast(rank() over (order by year({_MONTHS}) desc, o_custkey % 100) as int) as rank_index from orders)
        where rank_index <= 50""",
)
def top_rank_global_computed_key(spark, sf):
    order = [F.year("month").desc(), "o_custkey % 100"]
    return rl.first_rank(_orders_by_month(spark, sf), 50, order_by=order, return_index_column=True)


@query(
    "seeded_order",
    """select o_orderkey, o_custkey from orders
       qualify row_number() over (partition by o_custkey
               order by md5(concat_ws('|', '7', cast(o_custkey as varchar), cast(o_orderkey as varchar))), o_orderkey) = 1""",
)
def seeded_order(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    draw = rl.seeded_order(7, F.col("o_custkey"), F.col("o_orderkey"))
    return rl.first_row(orders, 1, "o_custkey", [draw, "o_orderkey"])


# Record selection ----------------------------------------------------------------------------------------------------

_SOURCE_OF_ORDER = """case o_orderpriority when '1-URGENT' then 'gdppr' when '2-HIGH' then 'hes_apc'
    when '3-MEDIUM' then 'hes_op' when '4-NOT SPECIFIED' then 'hes_ae' else 'ssnap' end"""
_ORDERS_LONG = f"""select cast(o_custkey as string) as person_id,
    cast(date_trunc('quarter', o_orderdate) as date) as record_date, o_orderstatus as sex_code,
    o_orderstatus as sex, {_SOURCE_OF_ORDER} as data_source from orders"""
_PRIORITY = {"gdppr": 1, "hes_apc": 2, "hes_op": 3, "hes_ae": 3}
_LAST_DAY = "2024-12-31"
_BETWEEN = f"record_date >= date '1900-01-01' and record_date <= date '{_LAST_DAY}'"
_SEX_TIES = [
    (
        "sex",
        "sex_tie_flag",
        {"sex_code_tie_value": "sex_code", "sex_tie_value": "sex", "sex_tie_data_source": "data_source"},
    )
]


def _sex_selection(rows: str, where: str = _BETWEEN, priority: dict | None = _PRIORITY) -> str:
    where = f"person_id is not null and record_date is not null and sex is not null and {where}"
    return o.selection_sql(rows, ["sex_code", "sex"], _SEX_TIES, where, priority, ["sex_code", "sex"])


def _orders_long(spark, sf, person=None) -> DataFrame:
    """Orders as a multi-source table with many equal rows."""
    return table(spark, sf, "orders").select(
        (F.col("o_custkey").cast("string") if person is None else person).alias("person_id"),
        F.expr("cast(date_trunc('quarter', o_orderdate) as date) as record_date"),
        F.col("o_orderstatus").alias("sex_code"),
        F.col("o_orderstatus").alias("sex"),
        F.expr(f"{_SOURCE_OF_ORDER} as data_source"),
    )


@query("select_records_orders", _sex_selection(_ORDERS_LONG))
def select_records_orders(spark, sf):
    return rl.select_sex(_orders_long(spark, sf), max_record_date=_LAST_DAY)


CODELISTS = {
    "ethnicity_snomed": (o.SNOMED_ETHNICITY, "code string, description string, ethnic_category string"),
    "infection_icd10": (o.ICD10_INFECTION, "code string, description string, covid_status string"),
}


def codelists(spark: SparkSession) -> dict[str, DataFrame]:
    given = {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in CODELISTS.items()}
    return given | {name: packaged_codelist(spark, name) for name in ("antigen_tests", "infection_snomed")}


def long_rows(spark: SparkSession, sf: str, asset: str, sources: list[str] | None = None) -> DataFrame:
    """The multi-source table of an asset over the views, with its shared scans."""
    spec, lists = ASSETS[asset], {}
    needed = {spec.sources[s].codelist for s in spec.chosen(sources)} - {None}
    if needed:
        lists = {name: Codelist(rows, True) for name, rows in codelists(spark).items() if name in needed}
    parts = [
        rl.extract(view(spark, sf, spec.sources[labels[0]].table), spec, labels, lists)
        for labels in scans(spec, sources)
    ]
    return rl.combine_sources(parts)


def long_persons(spark: SparkSession, sf: str, asset: str) -> DataFrame:
    """The person ids of the views that feed an asset, in which hot persons are looked for."""
    views = [view(spark, sf, spec.table).select("person_id") for spec in ASSETS[asset].sources.values()]
    return rl.combine_sources(views).filter("person_id is not null")


for _asset, _spec in ASSETS.items():
    _name = "covid_positive" if _asset == "covid_positive" else f"{_asset}_multisource"
    query(_name, o.multisource_sql(_asset))(lambda spark, sf, a=_asset: long_rows(spark, sf, a))
    for _source in _spec.sources:
        query(f"extract_{_asset}_{_source}", o.multisource_sql(_asset, [_source]))(
            lambda spark, sf, a=_asset, s=_source: long_rows(spark, sf, a, [s])
        )

_DOB_WHERE = f"""record_date >= date_of_birth and {_BETWEEN}
    and date_of_birth >= date '1880-01-01' and date_of_birth <= date '{_LAST_DAY}'"""
_DOB_TIES = [
    (
        "date_of_birth",
        "date_of_birth_tie_flag",
        {"date_of_birth_tie_value": "date_of_birth", "date_of_birth_tie_data_source": "data_source"},
    )
]


_DOB_SELECTION = o.selection_sql(
    o.long_table("date_of_birth"), ["date_of_birth"], _DOB_TIES, _DOB_WHERE, _PRIORITY, ["date_of_birth"]
)


@query("dob_individual", _DOB_SELECTION)
def dob_individual(spark, sf):
    rows = long_rows(spark, sf, "date_of_birth")
    persons = long_persons(spark, sf, "date_of_birth")
    return rl.select_date_of_birth(rows, max_record_date=_LAST_DAY, max_date_of_birth=_LAST_DAY, persons=persons)


@query("sex_individual", _sex_selection(o.long_table("sex")))
def sex_individual(spark, sf):
    return rl.select_sex(long_rows(spark, sf, "sex"), max_record_date=_LAST_DAY, persons=long_persons(spark, sf, "sex"))


@query(
    "sex_individual_chosen_sources",
    _sex_selection(
        o.long_table("sex"),
        "record_date >= date '1996-06-30' - 30 and record_date <= date '2001-01-01' and data_source in ('hes_apc', 'hes_op', 'ssnap')",
        {"ssnap": 1, "hes_op": 2},
    ),
)
def sex_individual_chosen_sources(spark, sf):
    return rl.select_sex(
        long_rows(spark, sf, "sex"),
        min_record_date="1996-06-30 - 1 month",
        max_record_date="2001-01-01",
        filter_data_sources=["hes_apc", "hes_op", "ssnap"],
        priority_index={"ssnap": 1, "hes_op": 2},
        persons=long_persons(spark, sf, "sex"),
    )


_ETHNICITY_TIES = [
    (
        f"ethnicity_{n}_group",
        f"ethnicity_{n}_tie_flag",
        {
            f"ethnicity_{n}_tie_group": f"ethnicity_{n}_group",
            f"ethnicity_{n}_tie_data_source": "data_source",
        },
    )
    for n in (5, 18)
]


_ETHNICITY_SELECTION = o.selection_sql(
    o.long_table("ethnicity"),
    [c for c in o.COLUMNS["ethnicity"] if c.startswith("ethnicity_")],
    _ETHNICITY_TIES,
    f"ethnicity_18_code is not null and ethnicity_18_code not in ('', 'X', 'Z', '99') and {_BETWEEN}",
    {"gdppr_snomed": 1, "gdppr": 2, "hes_apc": 3, "hes_op": 4, "hes_ae": 4},
    ["ethnicity_18_code", "ethnicity_18_group", "ethnicity_5_group"],
)


@query("ethnicity_individual", _ETHNICITY_SELECTION)
def ethnicity_individual(spark, sf):
    rows = long_rows(spark, sf, "ethnicity")
    return rl.select_ethnicity(rows, max_record_date=_LAST_DAY, persons=long_persons(spark, sf, "ethnicity"))


def _lsoa_selection(priority: dict | None) -> str:
    ties = [("lsoa", "lsoa_tie_flag", {"lsoa_tie_value": "lsoa", "lsoa_tie_data_source": "data_source"})]
    return o.selection_sql(o.long_table("lsoa"), ["lsoa"], ties, _BETWEEN, priority, ["lsoa"], recency_first=True)


@query("lsoa_individual", _lsoa_selection(_PRIORITY))
def lsoa_individual(spark, sf):
    return rl.select_lsoa(long_rows(spark, sf, "lsoa"), max_record_date=_LAST_DAY, persons=long_persons(spark, sf, "lsoa"))


@query("lsoa_individual_no_priority", _lsoa_selection(None))
def lsoa_individual_no_priority(spark, sf):
    rows = long_rows(spark, sf, "lsoa")
    persons = long_persons(spark, sf, "lsoa")
    return rl.select_lsoa(rows, max_record_date=_LAST_DAY, priority_index=None, persons=persons)


# Codelists -----------------------------------------------------------------------------------------------------------


@query(
    "covid_codelist_inner",
    f"""select person_id, code, description, covid_status from v_gdppr
        join {o.inline(values.INFECTION_CODES, "code, description, covid_status")} using (code)""",
)
def covid_codelist_inner(spark, sf):
    rows = view(spark, sf, "gdppr").select("person_id", "code")
    return rl.match_codelist(rows, packaged_codelist(spark, "infection_snomed"))


@query(
    "covid_codelist_left",
    f"""select person_id, code, testresult, description, test_result
        from (select person_id, testresult, nullif(regexp_extract(testresult, 'SCT:([0-9]+)', 1), '') as code from v_pillar_2)
        left join {o.inline(values.ANTIGEN_TESTS, "code, description, test_result")} using (code)""",
)
def covid_codelist_left(spark, sf):
    rows = view(spark, sf, "pillar_2").selectExpr(
        "person_id", "testresult", "nullif(regexp_extract(testresult, 'SCT:([0-9]+)', 1), '') as code"
    )
    return rl.match_codelist(rows, packaged_codelist(spark, "antigen_tests"), how="left")


@query(
    "codelist_from_customers",
    """select o_orderkey, code, segment from
       (select o_orderkey, cast(o_custkey as varchar) as code from orders)
       join (select cast(c_custkey as varchar) as code, c_mktsegment as segment from customer) using (code)""",
)
def codelist_from_customers(spark, sf):
    """A codelist that grows with the data: broadcast only as long as it is counted to be small."""
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "cast(o_custkey as string) as code")
    listed = table(spark, sf, "customer").selectExpr("cast(c_custkey as string) as code", "c_mktsegment as segment")
    return rl.match_codelist(rows, listed)


def _nation_csv(spark, sf) -> str:
    folder = scratch(spark)
    nations = table(spark, sf, "nation").selectExpr("cast(n_nationkey as string) as code", "n_name", "n_regionkey")
    spark.createDataFrame([], "x int").write.csv(f"{folder}/parent")
    rl.export_small_csv(nations, f"{folder}/parent/nations")
    return f"{folder}/parent/nations"


@query(
    "lookup_table_unique",
    """select c_custkey, n_name as nation, cast(n_regionkey as varchar) as region
       from customer left join nation on c_nationkey = n_nationkey""",
)
def lookup_table_unique(spark, sf):
    nations = rl.lookup_table(spark, _nation_csv(spark, sf), "code", ["n_name", "n_regionkey"], True)
    customers = table(spark, sf, "customer").selectExpr("c_custkey", "cast(c_nationkey as string) as key")
    matched = rl.match_codelist(customers, nations, on="key", how="left")
    return matched.selectExpr("c_custkey", "value.n_name as nation", "value.n_regionkey as region")


@query(
    "lookup_mapping_values",
    "select s.c_custkey, n_name as nation from customer s left join nation on c_nationkey = n_nationkey",
)
def lookup_mapping_values(spark, sf):
    nations = rl.lookup_mapping(rl.lookup_table(spark, _nation_csv(spark, sf), "code", "n_name"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return rl.map_values(customers, nations, "c_nationkey", "nation").drop("c_nationkey")


@query(
    "export_small_csv",
    "select o_orderstatus, o_orderpriority, cast(count(*) as varchar) as n from orders group by all",
)
def export_small_csv(spark, sf):
    folder = scratch(spark)
    spark.createDataFrame([], "x int").write.csv(f"{folder}/parent")
    counts = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    rl.export_small_csv(counts, f"{folder}/parent/counts")
    return rl.read_codelist(spark, f"{folder}/parent/counts")


@query(
    "lookup_named_values",
    """select c_custkey, n_name as nation, cast(n_regionkey as varchar) as region
       from customer left join nation on c_nationkey = n_nationkey""",
)
def lookup_named_values(spark, sf):
    """A lookup with named values and whole-number keys, by the table and once more by a dictionary."""
    lookup = rl.lookup_table(spark, _nation_csv(spark, sf), "code", ["n_name", "n_regionkey"], True, key_type="bigint")
    customers = rl.map_values(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), lookup, "c_nationkey", "by_table")
    both = rl.map_values(customers, rl.lookup_mapping(lookup), "c_nationkey", "by_dictionary")
    return both.selectExpr("c_custkey", "by_table.n_name as nation", "by_dictionary.n_regionkey as region")


_DESCRIBED = """select cast(n_nationkey as varchar) as code,
    case n_nationkey % 5 when 0 then concat('a "', n_name, '" text, more') when 1 then concat(n_name, {newline}, 'next, line')
         when 2 then concat('00', cast(n_nationkey as varchar)) when 3 then 'NA' else concat({bom}, n_name, ' \\ "') end as description
    from {nation}"""


def _described(spark, sf) -> DataFrame:
    return spark.sql(_DESCRIBED.format(newline="char(10)", bom="decode(unhex('EFBBBF'), 'UTF-8')", nation="{nation}").replace("varchar", "string").replace("\\", "\\\\"), nation=table(spark, sf, "nation"))


@query("export_quoted", _DESCRIBED.format(newline="chr(10)", bom="chr(65279)", nation="nation"))
def export_quoted(spark, sf):
    """Quotes, commas, line breaks, leading zeros and words that look like missing values, written and read again."""
    folder = scratch(spark)
    spark.createDataFrame([], "x int").write.csv(f"{folder}/parent")
    rl.export_small_csv(_described(spark, sf), f"{folder}/parent/described")
    return rl.read_codelist(spark, f"{folder}/parent/described")


@query("read_codelist_quoted", _DESCRIBED.format(newline="chr(10)", bom="chr(65279)", nation="nation"))
def read_codelist_quoted(spark, sf):
    """The same, from a file with doubled quotes that was put together by hand."""
    quoted = F.concat(F.lit('"'), F.regexp_replace("description", '"', '""'), F.lit('"'))
    lines = _described(spark, sf).select(F.concat("code", F.lit(","), quoted).alias("line"))
    header = spark.range(1).select(F.lit("code,description").alias("line"))
    folder = scratch(spark)
    text = header.select(F.lit(0).alias("k"), "line").unionByName(lines.select(F.lit(1).alias("k"), "line"))
    text.repartition(1).sortWithinPartitions("k").select("line").write.text(folder)
    return rl.read_codelist(spark, folder)


@query("extract_with_wide_codelist", o.multisource_sql("covid_positive", ["hes_apc_any_diagnosis"]))
def extract_with_wide_codelist(spark, sf):
    """A codelist with a further column by which its codes repeat."""
    rows, schema = CODELISTS["infection_icd10"]
    wide = [(*row, version) for row in rows for version in ("1", "2")]
    listed = spark.createDataFrame(wide, schema + ", version string")
    spec = ASSETS["covid_positive"]
    return rl.extract(view(spark, sf, "hes_apc_diagnosis"), spec, "hes_apc_any_diagnosis", {"infection_icd10": listed})


# Cohort --------------------------------------------------------------------------------------------------------------

CRITERIA = {
    "valid_person": "person_id is not null",
    "high_value": "o_totalprice >= 100000",
    "from_1997": "order_date >= date '1997-01-01'",
    "known_status": "status <> 'P'",
}
_COHORT = """select o_orderkey as row_id,
    case when o_orderkey % 97 = 0 then null else cast(o_custkey as string) end as person_id, o_totalprice,
    case when o_orderkey % 19 = 0 then null else cast(o_orderdate as date) end as order_date,
    case when o_orderkey % 13 = 0 then null else o_orderstatus end as status from {orders}"""
_FLAGS = ", ".join(f"coalesce({sql}, false) as {name}" for name, sql in CRITERIA.items())
_STEPS = ", ".join(
    f"{' and '.join(list(CRITERIA)[:i]) or 'true'} as criteria_{i}" for i in range(len(CRITERIA) + 1)
)
_FLAGGED = f"""select *, criteria_{len(CRITERIA)} as include from (select *, {_STEPS} from
    (select *, {_FLAGS} from ({_COHORT.format(orders="orders")})))"""


def cohort(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_COHORT, orders=table(spark, sf, "orders"))


@query("inclusion_flags", f"select * replace (cast(order_date as varchar) as order_date) from ({_FLAGGED})")
def inclusion_flags(spark, sf):
    return rl.flag_inclusion(cohort(spark, sf), CRITERIA)


@query(
    "inclusion_filtered",
    f"""select row_id, person_id, o_totalprice, cast(order_date as varchar) as order_date, status
        from ({_FLAGGED}) where include""",
)
def inclusion_filtered(spark, sf):
    return rl.apply_inclusion_criteria(cohort(spark, sf), CRITERIA)


_LABELS = [("Original table", ""), *CRITERIA.items()]


def _flowchart_sql() -> str:
    counts = " union all ".join(
        f"""select cast({i} as int) as criteria_index, 'criteria_{i}' as criteria, '{_LABELS[i][0]}' as description,
            '{_LABELS[i][1].replace("'", "''")}' as expression, count(*) filter (criteria_{i}) as n_row,
            count(distinct case when criteria_{i} then person_id end) as n_distinct_id from flagged"""
        for i in range(len(_LABELS))
    )
    return f"""with flagged as ({_FLAGGED}), counts as ({counts})
        select *, lag(n_row) over (order by criteria_index) - n_row as excluded_rows,
               lag(n_distinct_id) over (order by criteria_index) - n_distinct_id as excluded_ids from counts"""


@query("inclusion_flowchart", _flowchart_sql())
def inclusion_flowchart(spark, sf):
    return rl.inclusion_flowchart(rl.flag_inclusion(cohort(spark, sf), CRITERIA), CRITERIA)


@query("inclusion_flowchart_saved", _flowchart_sql())
def inclusion_flowchart_saved(spark, sf):
    directory = entries(scratch_database(spark, "flowchart"), "flowchart")
    rl.apply_inclusion_criteria(cohort(spark, sf), CRITERIA, "flowchart", directory=directory)
    return rl.load_table(spark, "flowchart", directory)


# Disclosure control --------------------------------------------------------------------------------------------------

_DAILY = "select cast(o_orderdate as date) as day, o_orderpriority, count(*) as n from orders group by all"


def _daily_counts(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("day"), "o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "round_counts",
    f"select cast(day as varchar) as day, o_orderpriority, cast(round(n / 5.0) * 5 as bigint) as n from ({_DAILY})",
)
def round_counts(spark, sf):
    return rl.round_counts(_daily_counts(spark, sf), ["n"], 5)


@query(
    "redact_null",
    f"select cast(day as varchar) as day, o_orderpriority, case when n >= 2 then n end as n from ({_DAILY})",
)
def redact_null(spark, sf):
    return rl.redact_low_counts(_daily_counts(spark, sf), ["n"], 2)


@query(
    "redact_string",
    f"""select cast(day as varchar) as day, o_orderpriority,
        case when n >= 2 then cast(n as varchar) else '[:REDACTED:]' end as n from ({_DAILY})""",
)
def redact_string(spark, sf):
    return rl.redact_low_counts(_daily_counts(spark, sf), ["n"], 2, "[:REDACTED:]")


@query(
    "redact_integer",
    f"""select cast(day as varchar) as day, o_orderpriority, case when n >= 2 then n else 0 end as n from ({_DAILY})""",
)
def redact_integer(spark, sf):
    return rl.redact_low_counts(_daily_counts(spark, sf), ["n"], 2, 0)


# Wrangling -----------------------------------------------------------------------------------------------------------

_MELTED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "melt_measures",
    " union all ".join(
        f"select l_orderkey, l_linenumber, '{c}' as variable, {c} as value from lineitem" for c in _MELTED
    ),
)
def melt_measures(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rl.melt(rows, ("l_orderkey", "l_linenumber"), _MELTED)


@query(
    "melt_mixed_types",
    """select o_orderkey, 'o_orderstatus' as field, o_orderstatus as content from orders
       union all select o_orderkey, 'o_custkey', cast(o_custkey as varchar) from orders""",
)
def melt_mixed_types(spark, sf):
    orders = table(spark, sf, "orders")
    return rl.melt(orders, ["o_orderkey"], ["o_orderstatus", "o_custkey"], "field", "content", as_string=True)


@query(
    "clean_names",
    """select c_custkey as customer_key, c_name as _1st_name, c_name as _1st_name_2, c_name as _1st_name_2_2,
       c_mktsegment as mkt_segment_ from customer""",
)
def clean_names(spark, sf):
    customers = table(spark, sf, "customer")
    return rl.clean_column_names(
        customers.select(
            F.col("c_custkey").alias("Customer Key"),
            F.col("c_name").alias("1st name"),
            F.col("c_name").alias("1st-Name"),
            F.col("c_name").alias("_1st_name_2"),
            F.col("c_mktsegment").alias("mkt(segment)"),
        )
    )


_STATUS = {"F": "Finished", "O": "Open"}


@query(
    "map_values",
    f"select o_orderkey, o_orderstatus, {o.choose('o_orderstatus', _STATUS)} as status from orders",
)
def map_values(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return rl.map_values(orders, _STATUS, "o_orderstatus", "status")


@query(
    "recode_pass_through",
    """select o_orderkey, case o_orderstatus when 'F' then 'Finished' when 'O' then null else o_orderstatus end
       as o_orderstatus from orders""",
)
def recode_pass_through(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return rl.recode(orders, {"F": "Finished", "O": None}, "o_orderstatus")


# More entries than anyone would write out, by a rule; values of two number types and nulls.
_LARGE_MAP = {k: None if k % 10 == 0 else k / 2 if k % 3 == 0 else k for k in range(1, 1001)}


@query(
    "map_values_large",
    """select o_orderkey, o_custkey, case when o_custkey % 10 = 0 or o_custkey > 1000 then null
              when o_custkey % 3 = 0 then o_custkey / 2.0e0 else cast(o_custkey as double) end as mapped from orders""",
)
def map_values_large(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rl.map_values(orders, _LARGE_MAP, "o_custkey", "mapped")


# Dates and filters ---------------------------------------------------------------------------------------------------


@query(
    "within_dates",
    """select l_orderkey, l_linenumber from
       (select *, cast(l_shipdate as date) as shipped, cast(o_orderdate as date) as ordered
        from lineitem join orders on l_orderkey = o_orderkey)
       where shipped >= date '1996-01-01' and shipped >= ordered - 14 and shipped <= ordered + 365""",
)
def within_dates(spark, sf):
    shipped = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "to_date(l_shipdate) as shipped")
    ordered = table(spark, sf, "orders").selectExpr("o_orderkey as l_orderkey", "o_orderdate as ordered")
    rows = rl.within_dates(shipped, "shipped", "1996-01-01").join(ordered, "l_orderkey")
    return rl.within_dates(rows, "shipped", "ordered - 2 weeks", "ordered + 1 year").select(
        "l_orderkey", "l_linenumber"
    )


_OFFSETS = {
    "plus_days": ("l_shipdate + 5 days", "shipped + 5"),
    "minus_weeks": ("l_shipdate - 7.5 weeks", "shipped - 53"),
    "plus_months": ("l_shipdate + 3 months", "shipped + 90"),
    "minus_years": ("l_shipdate - 2 years", "shipped - 731"),
    "two_terms": ("l_shipdate + 1 year - 5 days", "shipped + 360"),
    "unchanged": ("l_shipdate", "shipped"),
    "literal": ("2020-02-29 + 1 week", "date '2020-03-07'"),
    "latest": ("greatest(to_date(l_shipdate) + 2 weeks, date '1998-01-01')", "greatest(shipped + 14, date '1998-01-01')"),
}


@query(
    "date_offset",
    "select l_orderkey, l_linenumber, "
    + ", ".join(f"cast({sql} as varchar) as {name}" for name, (_, sql) in _OFFSETS.items())
    + " from (select *, cast(l_shipdate as date) as shipped from lineitem)",
)
def date_offset(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return rows.select(
        "l_orderkey", "l_linenumber", *[date_bound(text).alias(name) for name, (text, _) in _OFFSETS.items()]
    )


@query(
    "dob_from_age",
    """select l_orderkey, l_linenumber,
       cast(d - cast(round((case when age < 1 then age else age + 0.5e0 end) * 365.25e0) as int) as varchar) as born,
       cast(d - cast(round((age + 0.5e0) * 365.25e0) as int) as varchar) as born_completed
       from (select *, cast(l_shipdate as date) as d,
                    case when l_linenumber = 1 then l_discount * 10 when l_linenumber = 7 then null else l_quantity end as age
             from lineitem)""",
)
def dob_from_age_query(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn(
        "age", F.expr("case when l_linenumber = 1 then l_discount * 10 when l_linenumber = 7 then null else l_quantity end")
    )
    day, age = F.col("l_shipdate"), F.col("age")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        dob_from_age(day, age).alias("born"),
        dob_from_age(day, age, completed_years=True).alias("born_completed"),
    )


@query(
    "filter_sources_and_codes",
    f"""select person_id, ethnicity_18_code, data_source from ({o.long_table("ethnicity")})
        where ethnicity_18_code is not null and ethnicity_18_code not in ('', 'X', 'Z', '99')
        and data_source in ('gdppr', 'hes_ae')""",
)
def filter_sources_and_codes(spark, sf):
    rows = rl.filter_sources(long_rows(spark, sf, "ethnicity"), ["gdppr", "hes_ae"])
    rows = rl.exclude_codes(rows, "ethnicity_18_code", values.ETHNICITY_NULL_CODES)
    return rows.select("person_id", "ethnicity_18_code", "data_source")


# Standardisation -----------------------------------------------------------------------------------------------------

# Method: the view, its person column as delivered, and another column renamed so that it needs cleaning.
_DELIVERED = {
    "gdppr": ("gdppr", "NHS_NUMBER_DEID", ("code", "CODE")),
    "hes_apc": ("hes_apc", "PERSON_ID_DEID", ("mydob", "MYDOB")),
    "hes_op": ("hes_op", "PERSON_ID_DEID", ("ethnos", "ETHNOS")),
    "hes_ae": ("hes_ae", "PERSON_ID_DEID", ("lsoa11", "LSOA11")),
    "pillar_2": ("pillar_2", "Person_ID_DEID", ("testresult", "TestResult")),
    "ssnap": ("ssnap", "Person_ID_DEID", ("s1gender", "S1Gender")),
    "sgss": ("sgss", "PERSON_ID_DEID", ("specimen_date", "Specimen Date")),
    "primary_care_meds": ("hes_op", "Person_ID_DEID", ("sex", "Sex")),
    "chess": ("chess", "PERSON_ID_DEID", ("covid19", "COVID19")),
}
_DATE_COLUMNS = {
    "gdppr": ("date", "record_date", "archived_on"),
    "hes_apc": ("epistart",),
    "hes_op": ("apptdate",),
    "hes_ae": ("arrivaldate",),
    "pillar_2": ("teststartdate",),
    "ssnap": (),
    "sgss": ("specimen_date", "lab_report_date"),
    "chess": ("hospitaladmissiondate",),
}


def _standardise_query(method: str) -> None:
    name, person, (clean, messy) = _DELIVERED[method]
    dates = ", ".join(f"cast({c} as varchar) as {c}" for c in _DATE_COLUMNS[name])
    shown = f"* replace ({dates})" if dates else "*"
    if method == "ssnap":
        shown = "* replace (cast(cast(s1firstarrivaldatetime as date) as varchar) as s1firstarrivaldatetime)"

    @query(f"standardise_{method}", f"select {shown} from v_{name}")
    def standardised(spark, sf):
        delivered = view(spark, sf, name).withColumnsRenamed({"person_id": person, clean: messy})
        df = rl.standardise(delivered, method)
        return df.withColumn("s1firstarrivaldatetime", F.to_date("s1firstarrivaldatetime")) if method == "ssnap" else df


for _method in _DELIVERED:
    _standardise_query(_method)


@query(
    "standardise_deaths",
    """select DEC_CONF_NHS_NUMBER_CLEAN_DEID as person_id,
       cast(cast(try_strptime(REG_DATE_OF_DEATH, '%Y%m%d') as date) as varchar) as date_of_death,
       cast(cast(try_strptime(REG_DATE, '%Y%m%d') as date) as varchar) as reg_date from v_deaths_raw""",
)
def standardise_deaths(spark, sf):
    return rl.standardise(view(spark, sf, "deaths_raw"), "deaths")


_VACCINATIONS = """select cast(user_id as string) as PERSON_ID_DEID,
    case when event_id % 7 = 0 then 'unknown' else {day} end as RECORDED_DATE,
    concat('2025', '12', case when event_id % 5 = 0 then '32' else '31' end) as EXPIRY_DATE,
    case when event_id % 3 = 0 then null else concat({day}, 'T', {time}, '00') end as DATE_AND_TIME from {events}"""


@query(
    "standardise_vaccine_status",
    f"""select PERSON_ID_DEID as person_id,
        cast(cast(try_strptime(RECORDED_DATE, '%Y%m%d') as date) as varchar) as recorded_date,
        cast(cast(try_strptime(EXPIRY_DATE, '%Y%m%d') as date) as varchar) as expiry_date,
        cast(try_strptime(left(DATE_AND_TIME, 15), '%Y%m%dT%H%M%S') as varchar) as date_and_time
        from ({_VACCINATIONS.format(day="strftime(ts, '%Y%m%d')", time="strftime(ts, '%H%M%S')", events="events")})""",
)
def standardise_vaccine_status(spark, sf):
    text = _VACCINATIONS.format(
        day="date_format(ts, 'yyyyMMdd')", time="date_format(ts, 'HHmmss')", events="{events}"
    )
    return rl.standardise(spark.sql(text, events=table(spark, sf, "events")), "vaccine_status")


# Versions and snapshots ----------------------------------------------------------------------------------------------

_GDPPR = "select person_id, code, cast(archived_on as varchar) as archived_on from v_gdppr"


def _gdppr(spark, sf):
    return view(spark, sf, "gdppr").select("person_id", "code", "archived_on")


@query("at_version_exact", f"{_GDPPR} where archived_on = date '2024-01-20'")
def at_version_exact(spark, sf):
    return rl.at_version(_gdppr(spark, sf), "2024-01-20")


@query("at_version_latest", f"{_GDPPR} where archived_on = (select max(archived_on) from v_gdppr)")
def at_version_latest(spark, sf):
    return rl.at_version(_gdppr(spark, sf), "latest")


@query("up_to_version", f"{_GDPPR} where archived_on <= date '2024-01-20'")
def up_to_version(spark, sf):
    return rl.up_to_version(_gdppr(spark, sf), "2024-01-20")


@query("archive_versions", "select distinct cast(archived_on as varchar) as archived_on from v_gdppr")
def archive_versions(spark, sf):
    return rl.archive_versions(_gdppr(spark, sf))


_DEMOGRAPHICS = """select distinct cast(archived_on as varchar) as archived_on, person_id, practice,
    cast(reporting_period_end_date as varchar) as reporting_period_end_date, sex, lsoa, ethnic, year_month_of_birth
    from v_gdppr_demographics where person_id is not null"""


@query("demographics_summary", _DEMOGRAPHICS)
def demographics_summary(spark, sf):
    return rl.summarise_demographics(view(spark, sf, "gdppr_demographics"))


@query(
    "demographics_new_versions",
    """select distinct cast(archived_on as varchar) as archived_on from v_gdppr
       where archived_on not in (select archived_on from v_gdppr where archived_on <= date '2024-01-10')""",
)
def demographics_new_versions(spark, sf):
    rows = _gdppr(spark, sf)
    return rl.new_versions(rows, rl.up_to_version(rows, "2024-01-10"))


@query("save_and_reload", f"{_GDPPR} where archived_on = (select max(archived_on) from v_gdppr)")
def save_and_reload(spark, sf):
    directory = entries(scratch_database(spark, "save_and_reload"), "gdppr")
    directory["gdppr"]["archive_date"] = "latest"
    rl.save_table(_gdppr(spark, sf), "gdppr", directory, partition_by="archived_on")
    return rl.load_table(spark, "gdppr", directory)


@query("update_demographics", _DEMOGRAPHICS)
def update_demographics(spark, sf):
    """A snapshot of the older version, then an update that adds the newer one and an update with nothing to add."""
    directory = entries(scratch_database(spark, "update_demographics"), "gdppr_all_versions", "gdppr_demographics_all_versions")
    rows = view(spark, sf, "gdppr_demographics")
    rl.save_table(rl.up_to_version(rows, "1998-01-01"), "gdppr_all_versions", directory, "archived_on")
    rl.update_demographics(spark, directory)
    rl.save_table(rows, "gdppr_all_versions", directory, "archived_on")
    rl.update_demographics(spark, directory)
    rl.update_demographics(spark, directory)
    return rl.load_table(spark, "gdppr_demographics_all_versions", directory)


@query("update_demographics_changed", _DEMOGRAPHICS)
def update_demographics_changed(spark, sf):
    """The older versions are first delivered with other contents; the update finds and rebuilds those, and only those."""
    keys = ("gdppr_all_versions", "gdppr_demographics_all_versions", "fingerprints")
    directory = entries(scratch_database(spark, "update_demographics_changed"), *keys)
    rows = view(spark, sf, "gdppr_demographics")
    older = F.col("archived_on") <= F.lit("1998-01-01").cast("date")
    rl.save_table(rows.withColumn("sex", F.when(older, "?").otherwise(F.col("sex"))), keys[0], directory, "archived_on")
    rl.update_demographics(spark, directory, fingerprints="fingerprints")
    rl.save_table(rows, keys[0], directory, "archived_on")
    rl.update_demographics(spark, directory, fingerprints="fingerprints")
    return rl.load_table(spark, keys[1], directory)


def _as_delivered(df: DataFrame, name: str) -> DataFrame:
    """Vaccination dates come as digits; all other tables are delivered like the views."""
    if name != "vaccine_status":
        return df
    unknown = F.lit(None).cast("string")
    return df.withColumns({"recorded_date": F.date_format("recorded_date", "yyyyMMdd"), "expiry_date": unknown, "date_and_time": unknown})


def _built_and_saved(spark, sf, asset: str, bounds: dict, **options) -> DataFrame:
    """From saved source tables to the saved individual table, by table keys."""
    tables = sorted({spec.table for spec in ASSETS[asset].sources.values()})
    directory = entries(scratch_database(spark, f"{asset}{sorted(options)}"), *tables, f"{asset}_multisource", f"{asset}_individual")
    for name in tables:
        rl.save_table(_as_delivered(view(spark, sf, name), name), name, directory)
    rl.build_multisource(spark, asset, directory, codelists=options.get("codelists"))
    rl.build_individual(spark, asset, directory, bounds=bounds)
    return rl.load_table(spark, f"{asset}_individual", directory)


_RECORD_BOUNDS = {"record_date": ("1900-01-01", _LAST_DAY)}


@query("sex_built_and_saved", _sex_selection(o.long_table("sex")))
def sex_built_and_saved(spark, sf):
    return _built_and_saved(spark, sf, "sex", _RECORD_BOUNDS)


@query("lsoa_built_and_saved", _lsoa_selection(_PRIORITY))
def lsoa_built_and_saved(spark, sf):
    return _built_and_saved(spark, sf, "lsoa", _RECORD_BOUNDS)


@query("dob_built_and_saved", _DOB_SELECTION)
def dob_built_and_saved(spark, sf):
    return _built_and_saved(spark, sf, "date_of_birth", _RECORD_BOUNDS | {"date_of_birth": ("1880-01-01", _LAST_DAY)})


# A mapping of some hundred codes, by a rule: the codes of the view and others that occur nowhere.
_LONG_MAPPING = o.SNOMED_ETHNICITY + [(str(500_000_000 + 7 * i), f"Group {i}", "ABCDEFGHJKLMNPRSZ"[i % 17]) for i in range(450)]


@query("ethnicity_built_and_saved", _ETHNICITY_SELECTION)
def ethnicity_built_and_saved(spark, sf):
    mapping = spark.createDataFrame(_LONG_MAPPING, CODELISTS["ethnicity_snomed"][1])
    return _built_and_saved(spark, sf, "ethnicity", _RECORD_BOUNDS, codelists={"ethnicity_snomed": mapping})


@query("equal_rows_built_and_saved", _sex_selection(_ORDERS_LONG))
def equal_rows_built_and_saved(spark, sf):
    """A long table of other origin, with many equal rows, through the default selection."""
    directory = entries(scratch_database(spark, "equal_rows"), "sex_multisource", "sex_individual")
    rl.save_table(_orders_long(spark, sf), "sex_multisource", directory)
    rl.build_individual(spark, "sex", directory, bounds=_RECORD_BOUNDS)
    return rl.load_table(spark, "sex_individual", directory)


_HOT_ROWS = _ORDERS_LONG.replace("cast(o_custkey as string) as person_id", "case when o_orderkey % 3 = 0 then 'hot' else cast(o_custkey as string) end as person_id")


@query("hot_person_selected", _sex_selection(_HOT_ROWS))
def hot_person_selected(spark, sf):
    """One person holds a third of all rows."""
    hot = F.when(F.col("o_orderkey") % 3 == 0, "hot").otherwise(F.col("o_custkey").cast("string"))
    return rl.select_sex(_orders_long(spark, sf, hot), max_record_date=_LAST_DAY)


@query("sex_individual_until_today", _sex_selection(o.long_table("sex"), "record_date >= date '1900-01-01' and record_date <= current_date"))
def sex_individual_until_today(spark, sf):
    return rl.select_sex(long_rows(spark, sf, "sex"), persons=long_persons(spark, sf, "sex"))


@query("covid_positive_built_and_saved", o.multisource_sql("covid_positive"))
def covid_positive_built_and_saved(spark, sf):
    tables = sorted({spec.table for spec in ASSETS["covid_positive"].sources.values()})
    directory = entries(scratch_database(spark, "covid_positive"), *tables, "covid_positive")
    for name in tables:
        rl.save_table(view(spark, sf, name), name, directory)
    rl.build_covid_positive(spark, directory, codelists={"infection_icd10": codelists(spark)["infection_icd10"]})
    return rl.load_table(spark, "covid_positive", directory)
