"""Health-record shaped views over the driver tables, and how results are rendered for comparison.

Each view is one SQL text that both engines run. Every view reads its whole table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIEWS = {
    "gdppr": """
        select cast(user_id as string) as person_id,
               case when event_id % 11 = 0 then null else cast(ts as date) end as date,
               case event_id % 13 when 0 then null when 1 then date '1899-12-30' else cast(ts as date) end as record_date,
               case event_id % 6 when 0 then '1240581000000104' when 1 then '1300721000000109' when 2 then '413773004'
                    when 3 then '414752008' when 4 then '415226007' else '999' end as code,
               case when cast(ts as date) < date '2024-01-11' then date '2024-01-10'
                    when cast(ts as date) < date '2024-01-21' then date '2024-01-20' else date '2024-01-31' end as archived_on
        from {events}
    """,
    "gdppr_demographics": """
        select case when o_orderkey % 97 = 0 then null else cast(o_custkey as string) end as person_id,
               cast(date_trunc('month', o_orderdate) as date) as reporting_period_end_date,
               concat('P', cast(o_custkey % 20 as string)) as practice,
               case o_orderkey % 7 when 0 then '0' when 1 then '1' when 2 then '2' when 3 then '9' when 4 then null when 5 then '1' else '2' end as sex,
               case when o_orderkey % 23 = 0 then null else concat('E0100', cast(1000 + o_custkey % 40 + o_orderkey % 2 as string)) end as lsoa,
               case o_orderkey % 8 when 0 then 'A' when 1 then 'C' when 2 then 'H' when 3 then 'M' when 4 then 'Z' when 5 then null when 6 then '99' else 'R' end as ethnic,
               case when o_orderkey % 31 = 0 then null else concat(cast(1940 + o_custkey % 50 as string), '-0', cast(1 + o_custkey % 9 as string)) end as year_month_of_birth,
               case when o_orderdate < timestamp '1998-01-01 00:00:00' then date '1998-01-01' else date '2001-12-31' end as archived_on
        from {orders}
    """,
    "hes_apc": """
        select cast(o_custkey as string) as person_id,
               case when o_orderkey % 53 = 0 then null else cast(date_trunc('month', o_orderdate) as date) end as epistart,
               concat('0', cast(1 + o_orderkey % 9 as string), cast(1940 + o_custkey % 50 as string)) as mydob,
               case o_orderkey % 8 when 0 then '0' when 1 then '1' when 2 then '2' when 3 then '3' when 4 then '9' when 5 then 'X' when 6 then '1' else '2' end as sex,
               concat('E0100', cast(1000 + o_custkey % 40 + o_orderkey % 3 as string)) as lsoa11,
               case o_orderkey % 10 when 0 then '0' when 1 then '4' when 2 then '7' when 3 then '9' when 4 then 'A' when 5 then 'D' when 6 then 'X' when 7 then 'N' when 8 then '99' else 'Q' end as ethnos
        from {orders}
    """,
    "hes_apc_diagnosis": """
        select cast(o_custkey as string) as person_id, cast(o_orderdate as date) as epistart,
               case o_orderkey % 4 when 0 then 'U071' when 1 then 'U072' when 2 then 'I10' else 'X1' end as code,
               cast(1 + o_orderkey % 3 as int) as diag_position
        from {orders}
    """,
    "hes_op": """
        select cast(l_partkey as string) as person_id, cast(date_trunc('month', l_shipdate) as date) as apptdate,
               case when l_linenumber = 1 then l_discount * 10 when l_linenumber = 7 then null else l_quantity end as apptage_calc,
               case l_orderkey % 6 when 0 then '0' when 1 then '1' when 2 then '2' when 3 then '9' when 4 then 'X' else '3' end as sex,
               concat('E0100', cast(1000 + l_suppkey % 40 as string)) as lsoa11,
               case l_orderkey % 5 when 0 then 'B' when 1 then 'J' when 2 then 'Z' when 3 then 'W' else 'P' end as ethnos
        from {lineitem}
    """,
    "hes_ae": """
        select cast(l_orderkey as string) as person_id, cast(date_trunc('month', l_shipdate) as date) as arrivaldate,
               case when l_linenumber = 2 then l_discount * 10 else l_quantity end as arrivalage_calc,
               case l_partkey % 6 when 0 then '0' when 1 then '1' when 2 then '2' when 3 then '3' when 4 then '9' else 'X' end as sex,
               concat('E0100', cast(1000 + l_suppkey % 40 as string)) as lsoa11,
               case l_partkey % 5 when 0 then 'E' when 1 then 'K' when 2 then 'X' when 3 then 'S' else null end as ethnos
        from {lineitem}
    """,
    "ssnap": """
        select cast(o_custkey as string) as person_id, o_orderdate as s1firstarrivaldatetime,
               cast(20 + o_custkey % 70 as int) as s1ageonarrival,
               case o_custkey % 3 when 0 then 'M' when 1 then 'F' else null end as s1gender
        from {orders}
    """,
    "vaccine_status": """
        select cast(user_id as string) as person_id, cast(ts as date) as recorded_date,
               case event_id % 4 when 0 then 'bad' when 1 then null else concat('0', cast(1 + user_id % 9 as string), cast(1940 + user_id % 50 as string)) end as mydob,
               case when event_id % 5 = 0 then null else concat('E0100', cast(1000 + user_id % 40 as string)) end as lsoa
        from {events}
    """,
    "sgss": """
        select cast(user_id as string) as person_id,
               case when event_id % 3 = 0 then null else cast(ts as date) end as specimen_date,
               case when event_id % 6 = 0 then null else cast(ts as date) + 2 end as lab_report_date
        from {events}
    """,
    "pillar_2": """
        select cast(user_id as string) as person_id, cast(ts as date) as teststartdate,
               case event_id % 6 when 0 then 'SCT:1240581000000104' when 1 then 'SCT:1240591000000102' when 2 then 'Positive'
                    when 3 then 'Negative' when 4 then 'SCT:999' else 'SCT:1322781000000102' end as testresult
        from {events}
    """,
    "chess": """
        select cast(user_id as string) as person_id, cast(ts as date) as hospitaladmissiondate,
               case when event_id % 2 = 0 then 'Yes' else 'No' end as covid19
        from {events}
    """,
    "deaths_raw": """
        select cast(c_custkey as string) as DEC_CONF_NHS_NUMBER_CLEAN_DEID,
               case c_custkey % 5 when 0 then 'unknown' when 1 then '20201399' else concat('2020010', cast(1 + c_custkey % 9 as string)) end as REG_DATE_OF_DEATH,
               concat('2020020', cast(1 + c_custkey % 9 as string)) as REG_DATE
        from {customer}
    """,
}

TABLES = ("orders", "lineitem", "customer", "events", "nation", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a Spark table."""
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text})


def with_views(query: str) -> str:
    """Oracle text preceded by the views it names as ``v_<name>``."""
    used = [n for n in VIEWS if re.search(rf"\bv_{n}\b", query)]
    if not used:
        return query
    named = [f"v_{n} as ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in used]
    body = query.strip()
    rest = ", " + body[len("with ") :] if body.lower().startswith("with ") else "\n" + body
    return "with " + ",\n".join(named) + rest


def rendered(df: DataFrame) -> DataFrame:
    """Dates as ISO text and arrays as comma-separated text, so that both engines give plain values."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*map(plain, df.schema.fields))
