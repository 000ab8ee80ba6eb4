"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs over whole tables and writes its full result to the no-op sink. The multi-source tables are written
once to the scratch folder and selection is timed from there, as in production, where they are saved tables. With
``BENCH_SHAPES=1`` the plans a straightforward formulation leads to (three windows; unpivot and distinct count) are
timed too and reported under ``usual_shape``.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import recordloom as rl
from checks import queries as q
from checks.compare import local_session
from checks.views import view
from recordloom.sources import packaged_codelist

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
LAST_DAY = "2024-12-31"


def timed(df_of) -> float:
    """Median wall time of planning and running to the no-op sink, after one warm-up."""
    taken = []
    for _ in range(REPEATS + 1):
        start = time.perf_counter()
        df_of().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    return round(median(taken[1:]), 3)


def three_windows(df: DataFrame, values: list[str], tie: str, order: list, lists: dict) -> DataFrame:
    """Selection by dense rank, ties collected over full frames, and a random row."""
    person = Window.partitionBy("person_id")
    best = df.withColumn("best", F.dense_rank().over(person.orderBy(*order))).filter("best = 1")
    frame = person.orderBy("data_source", *values).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    tied = best.withColumn("flag", F.when(F.size(F.collect_set(tie).over(frame)) > 1, F.lit(1)))
    for name, column in lists.items():
        tied = tied.withColumn(name, F.when(F.col("flag") == 1, F.collect_list(column).over(frame)))
    drawn = F.row_number().over(person.orderBy(F.rand(seed=1)))
    return tied.withColumn("row", drawn).filter("row = 1").drop("row", "best")


def unpivoted_flowchart(cohort: DataFrame, criteria: dict) -> DataFrame:
    """Flowchart by unpivoting the cumulative flags and counting distinct persons."""
    flagged = rl.flag_inclusion(cohort, criteria)
    steps = [f"criteria_{i}" for i in range(len(criteria) + 1)]
    long = flagged.select("row_id", "person_id", *steps).unpivot(["row_id", "person_id"], steps, "criteria", "met")
    return long.groupBy("criteria").agg(
        F.count(F.when(F.col("met"), 1)).alias("n_row"),
        F.countDistinct(F.when(F.col("met"), F.col("person_id"))).alias("n_distinct_id"),
    )


def main() -> None:
    spark = local_session(CPUS)
    folder = q.scratch(spark)

    for asset in ("date_of_birth", "sex", "ethnicity", "lsoa"):
        q.long_rows(spark, SF_DIR, asset).write.parquet(f"{folder}/{asset}")

    def saved(asset: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{asset}")

    last = {"max_record_date": LAST_DAY}
    queries = {
        "date_of_birth_multisource": lambda: q.long_rows(spark, SF_DIR, "date_of_birth"),
        "sex_multisource": lambda: q.long_rows(spark, SF_DIR, "sex"),
        "ethnicity_multisource": lambda: q.long_rows(spark, SF_DIR, "ethnicity"),
        "lsoa_multisource": lambda: q.long_rows(spark, SF_DIR, "lsoa"),
        "covid_positive": lambda: q.long_rows(spark, SF_DIR, "covid_positive"),
        "date_of_birth_individual": lambda: rl.select_date_of_birth(
            saved("date_of_birth"), max_date_of_birth=LAST_DAY, **last
        ),
        "sex_individual": lambda: rl.select_sex(saved("sex"), **last),
        "ethnicity_individual": lambda: rl.select_ethnicity(saved("ethnicity"), **last),
        "lsoa_individual": lambda: rl.select_lsoa(saved("lsoa"), **last),
        "select_records_orders": lambda: q.QUERIES["select_records_orders"](spark, SF_DIR),
        "inclusion_flowchart": lambda: q.QUERIES["inclusion_flowchart"](spark, SF_DIR),
        "inclusion_filtered": lambda: q.QUERIES["inclusion_filtered"](spark, SF_DIR),
        "codelist_match": lambda: rl.match_codelist(
            view(spark, SF_DIR, "gdppr"), packaged_codelist(spark, "infection_snomed"), small=True
        ),
        "demographics_summary": lambda: q.QUERIES["demographics_summary"](spark, SF_DIR),
        "first_dense_rank_per_person": lambda: q.QUERIES["first_dense_rank_per_person"](spark, SF_DIR),
        "top_dense_rank_global": lambda: q.QUERIES["top_dense_rank_global"](spark, SF_DIR),
        "melt_measures": lambda: q.QUERIES["melt_measures"](spark, SF_DIR),
    }
    seconds = {name: timed(df_of) for name, df_of in queries.items()}
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }

    if os.environ.get("BENCH_SHAPES"):
        within = "{} between date '{}' and date '" + LAST_DAY + "'"
        dated = within.format("record_date", "1900-01-01")
        rank = rl.lookup(F.col("data_source"), q._PRIORITY)
        priority = [rank.asc_nulls_last(), F.col("record_date").desc()]
        eth = [c for c in saved("ethnicity").columns if c.startswith("ethnicity")]
        usual = {
            "date_of_birth_individual": lambda: three_windows(
                saved("date_of_birth").filter(f"record_date >= date_of_birth and {within.format('record_date', '1900-01-01')} and {within.format('date_of_birth', '1880-01-01')}"),
                ["date_of_birth"],
                "date_of_birth",
                priority,
                {"a": "date_of_birth", "b": "data_source"},
            ),
            "sex_individual": lambda: three_windows(
                saved("sex").filter(f"sex is not null and {dated}"),
                ["sex_code", "sex"],
                "sex",
                priority,
                {"a": "sex_code", "b": "sex", "c": "data_source"},
            ),
            "ethnicity_individual": lambda: three_windows(
                saved("ethnicity").filter(f"ethnicity_18_code not in ('', 'X', 'Z', '99') and {dated}"),
                eth,
                "ethnicity_18_group",
                priority,
                {"a": "ethnicity_18_group", "b": "data_source", "c": "ethnicity_5_group", "d": "data_source"},
            ),
            "lsoa_individual": lambda: three_windows(
                saved("lsoa").filter(dated), ["lsoa"], "lsoa", priority[::-1], {"a": "lsoa", "b": "data_source"}
            ),
            "inclusion_flowchart": lambda: unpivoted_flowchart(q.cohort(spark, SF_DIR), q.CRITERIA),
        }
        result["usual_shape"] = {name: timed(df_of) for name, df_of in usual.items()}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
