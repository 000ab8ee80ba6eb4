import datetime as dt
import hashlib
import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import recordloom as rl
from recordloom.operators import hot_keys
from recordloom.plans.selection import SEED

DAY = dt.date(2020, 1, 1)
LATER = dt.date(2021, 1, 1)
SEX = "person_id string, record_date date, sex_code string, sex string, data_source string"


def sex_rows(spark, data):
    return spark.createDataFrame(data, SEX)


def expected_selection(data, spec, priority, value):
    """The selection of a single-tie asset in plain Python, rows given as dictionaries."""
    people = defaultdict(list)
    for row in data:
        if row["person_id"] and row["record_date"] and all(row[c] is not None for c in spec.required):
            people[row["person_id"]].append(row)
    last = max(priority.values(), default=0) + 1

    def standing(row):
        rank, age = priority.get(row["data_source"], last), -row["record_date"].toordinal()
        return (age, rank) if spec.recency_first else (rank, age)

    def text(v):
        return v.isoformat() if isinstance(v, dt.date) else v

    def number(row):
        parts = [str(SEED), row["person_id"], row["data_source"], *[text(row[v]) for v in spec.values]]
        return hashlib.md5("|".join(p for p in parts if p is not None).encode()).hexdigest()

    def nulls_first(row):
        return [(row[c] is not None, row[c] or "") for c in ("data_source", *spec.tie_order)]

    result = []
    for person, rows in people.items():
        best = min(map(standing, rows))
        tied = sorted((r for r in rows if standing(r) == best), key=nulls_first)
        pick = min(tied, key=number)
        made = {**pick, "person_id": person}
        for tie in spec.ties:
            flag = 1 if len({r[tie.value] for r in tied} - {None}) > 1 else None
            made[tie.flag] = flag
            for name, column in tie.lists.items():
                made[name] = [r[column] for r in tied if r[column] is not None] if flag else None
        result.append(tuple(made[c] for c in spec.output))
    return sorted(result, key=repr)


def random_sex_rows(n, people, seed=5, repeated=True):
    draw = random.Random(seed)
    data = []
    for _ in range(n):
        code = draw.choice(["1", "2", "9", "M", "0"])
        data.append(
            {
                "person_id": draw.choice([None, *[f"p{i}" for i in range(people)]]),
                "record_date": draw.choice([None, *[DAY + dt.timedelta(days=30 * i) for i in range(4)]]),
                "sex_code": code,
                "sex": {"1": "M", "2": "F", "9": "I", "0": None}.get(code, code),
                "data_source": draw.choice(["gdppr", "hes_apc", "hes_op", "hes_ae", "ssnap"]),
            }
        )
    return data if repeated else [dict(t) for t in {tuple(row.items()) for row in data}]


@pytest.mark.parametrize("recency_first", [False, True])
@pytest.mark.parametrize("priority", [{"gdppr": 1, "hes_apc": 2, "hes_op": 3, "hes_ae": 3}, {"ssnap": 7, "gdppr": -2}, {}])
def test_agrees_with_plain_python(spark, rows, recency_first, priority):
    data = random_sex_rows(1500, 120)
    spec = replace(rl.SELECTIONS["sex"], recency_first=recency_first)
    df = sex_rows(spark, [tuple(row.values()) for row in data])
    got = rl.select_records(df, spec, priority_index=priority or None)
    assert rows(got) == expected_selection(data, spec, priority, "sex")


def test_result_does_not_depend_on_partitioning(spark, rows):
    data = [tuple(row.values()) for row in random_sex_rows(2000, 60)]
    df = sex_rows(spark, data)
    first = rows(rl.select_sex(df.repartition(1)))
    random.Random(1).shuffle(data)
    assert rows(rl.select_sex(sex_rows(spark, data).repartition(13))) == first


def test_ties(spark):
    data = [
        ("same", DAY, "1", "M", "gdppr"),
        ("same", DAY, "M", "M", "gdppr"),
        ("tied", DAY, "1", "M", "hes_op"),
        ("tied", DAY, "2", "F", "hes_ae"),
        ("tied", DAY, "2", "F", "hes_ae"),
        ("tied", LATER, "9", "I", "ssnap"),
        ("last", LATER, "1", "M", "ssnap"),
        ("last", DAY, "2", "F", "hes_ae"),
    ]
    found = {row["person_id"]: row for row in rl.select_sex(sex_rows(spark, data)).collect()}
    assert found["same"]["sex_tie_flag"] is None and found["same"]["sex_tie_value"] is None
    tied = found["tied"]
    assert tied["sex_tie_flag"] == 1 and tied["record_date"] == DAY
    assert tied["sex_tie_value"] == ["F", "F", "M"] and tied["sex_code_tie_value"] == ["2", "2", "1"]
    assert tied["sex_tie_data_source"] == ["hes_ae", "hes_ae", "hes_op"]
    assert (found["last"]["sex"], found["last"]["data_source"]) == ("F", "hes_ae")


def test_recency_comes_first_for_areas(spark):
    data = [("p", DAY, "E1", "gdppr"), ("p", LATER, "E2", "vaccine_status"), ("p", LATER, "E3", "hes_ae")]
    df = spark.createDataFrame(data, "person_id string, record_date date, lsoa string, data_source string")
    row = rl.select_lsoa(df).first()
    assert (row["lsoa"], row["data_source"], row["lsoa_tie_flag"]) == ("E3", "hes_ae", None)
    level = rl.select_lsoa(df, priority_index=None).first()
    # Both records of the last date tie, and every row would report the whole tie, whichever is picked.
    assert level["lsoa_tie_value"] == ["E3", "E2"] and level["lsoa_tie_data_source"] == ["hes_ae", "vaccine_status"]
    assert level["lsoa_tie_flag"] == 1


def test_unmapped_groups_are_left_out_of_lists(spark):
    spec = rl.SELECTIONS["ethnicity"]
    columns = ["person_id", "record_date", *spec.values, "data_source"]
    schema = ", ".join(f"{c} {'date' if c == 'record_date' else 'string'}" for c in columns)
    data = [
        ("p", DAY, "A", "British", "A", "British", "White", "gdppr"),
        ("p", DAY, "Q", None, "Q", None, None, "gdppr"),
        ("p", DAY, "R", "Chinese", "R", "Chinese", "Asian or Asian British", "gdppr"),
        ("p", DAY, "J", "Pakistani", "J", "Pakistani", "Asian or Asian British", "gdppr"),
        ("p", LATER, "Z", "Not stated", "Z", "Not stated", "Not known", "gdppr"),
    ]
    row = rl.select_ethnicity(spark.createDataFrame(data, schema)).first()
    assert row["record_date"] == DAY
    assert row["ethnicity_18_tie_group"] == ["British", "Pakistani", "Chinese"]
    assert row["ethnicity_18_tie_data_source"] == ["gdppr"] * 4
    assert row["ethnicity_5_tie_group"] == ["White", "Asian or Asian British", "Asian or Asian British"]
    kept = rl.select_ethnicity(spark.createDataFrame(data, schema), ethnicity_18_null_codes=[]).first()
    assert kept["ethnicity_18_code"] == "Z"


def test_dates_of_birth_must_be_plausible(spark, rows):
    data = [
        ("p", DAY, LATER, "gdppr"),
        ("p", DAY, dt.date(1870, 1, 1), "gdppr"),
        ("p", DAY, dt.date(1990, 1, 1), "hes_ae"),
        ("q", DAY, dt.date(1890, 1, 1), "gdppr"),
    ]
    df = spark.createDataFrame(data, "person_id string, record_date date, date_of_birth date, data_source string")
    got = rl.select_date_of_birth(df)
    assert rows(got, "person_id", "date_of_birth") == [
        ("p", dt.date(1990, 1, 1)),
        ("q", dt.date(1890, 1, 1)),
    ]
    assert rl.select_date_of_birth(df, min_date_of_birth="1900-01-01").count() == 1
    assert rl.select_date_of_birth(df, max_record_date="2020-01-01 - 1 day").count() == 0
    assert rl.select_date_of_birth(df, min_date_of_birth=None, max_date_of_birth=None).count() == 2


def test_arguments_are_checked(spark):
    df = sex_rows(spark, [("p", DAY, "1", "M", "gdppr")])
    for sources in ([], ["nowhere"], "gdppr", [1]):
        with pytest.raises(ValueError):
            rl.select_sex(df, filter_data_sources=sources)
    for priority in ({"gdppr": "1"}, {"nowhere": 1}, {"gdppr": 1.5}):
        with pytest.raises(ValueError):
            rl.select_sex(df, priority_index=priority)
    assert rl.select_sex(df, filter_data_sources=["hes_ae"]).count() == 0


def test_plans(spark, tmp_path, plan):
    path = str(tmp_path / "sex")
    sex_rows(spark, [("p", DAY, "1", "M", "gdppr")]).write.parquet(path)
    df = spark.read.parquet(path)
    text = plan(rl.select_sex(df, max_record_date="2024-01-01"))
    assert "LessThanOrEqual(record_date,2024-01-01)" in text and "IsNotNull(sex)" in text
    # one scan; every task cuts its persons to their best rows, then one shuffle of these
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2


def test_one_person_with_most_rows(spark):
    """A person with half of all rows, most of them equal."""
    df = spark.range(40_000).selectExpr(
        "if(id % 2 = 0, 'hot', concat('p', id % 900)) as person_id",
        "date_add(date '2020-01-01', cast(id % 400 as int)) as record_date",
        "cast(id % 5 as string) as sex_code",
        "cast(id % 2 + id % 3 as string) as sex",
        "if(id % 4 < 2, 'gdppr', 'hes_op') as data_source",
        "explode(array_repeat(0, cast(id % 3 + 1 as int))) as again",
    ).drop("again")
    got = rl.select_sex(df)
    hot = got.filter("person_id = 'hot'").first()
    best = df.filter("person_id = 'hot' and data_source = 'gdppr'")
    day = best.agg(F.max("record_date")).first()[0]
    assert hot["record_date"] == day
    assert len(hot["sex_tie_value"]) == best.filter(F.col("record_date") == F.lit(day)).count()
    assert got.count() == df.select("person_id").distinct().count()


def test_persons_with_very_many_rows_go_another_way(spark, rows, plan, monkeypatch):
    data = [tuple(row.values()) for row in random_sex_rows(3000, 60)]
    data += [("hot", LATER, str(k % 3), "MFI"[k % 3], "gdppr") for k in range(3000)]
    df = sex_rows(spark, data)
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 1 << 70)
    usual = rl.select_sex(df)
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 0)
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 1000)
    split = rl.select_sex(df)
    assert rows(split) == rows(usual)
    # of the hot person equal rows are counted in every task, and what is ranked are three rows
    assert "partial_count(1)" in plan(split) and "partial_count(1)" not in plan(usual)


def test_built_tables(spark, database, rows):
    keys = ("gdppr_demographics", "hes_apc", "lsoa_multisource", "lsoa_individual")
    directory = {key: {"database": database, "table_name": key} for key in keys}
    demographics = spark.createDataFrame([("p", DAY, "E1")], "person_id string, reporting_period_end_date date, lsoa string")
    episodes = spark.createDataFrame(
        [("p", LATER, "E2"), ("q", DAY, "E3")], "PERSON_ID_DEID string, EPISTART date, LSOA11 string"
    ).toDF("PERSON_ID_DEID", "EPISTART", "LSOA11")
    rl.save_table(demographics, "gdppr_demographics", directory)
    rl.save_table(episodes, "hes_apc", directory)
    rl.build_multisource(spark, "lsoa", directory, methods=["gdppr", "hes_apc"])
    assert rl.load_table(spark, "lsoa_multisource", directory).count() == 3
    rl.build_individual(spark, "lsoa", directory)
    individual = rl.load_table(spark, "lsoa_individual", directory)
    assert tuple(individual.columns) == rl.SELECTIONS["lsoa"].output
    assert rows(individual, "person_id", "lsoa") == [("p", "E2"), ("q", "E3")]


def test_equal_rows_are_kept_in_lists_by_default(spark, database):
    directory = {key: {"database": database, "table_name": key} for key in ("sex_multisource", "sex_individual")}
    data = [("p", DAY, "1", "M", "gdppr")] * 2 + [("p", DAY, "2", "F", "gdppr")]
    rl.save_table(sex_rows(spark, data), "sex_multisource", directory)
    rl.build_individual(spark, "sex", directory)
    assert rl.load_table(spark, "sex_individual", directory).first()["sex_tie_value"] == ["M", "M", "F"]


def test_large_inputs_are_dealt_to_tasks_by_size(spark, tmp_path, rows, plan, monkeypatch):
    data = [tuple(row.values()) for row in random_sex_rows(3000, 200)]
    sex_rows(spark, data).write.parquet(str(tmp_path / "sex"))
    df = spark.read.parquet(str(tmp_path / "sex"))
    usual = rows(rl.select_sex(df))
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 1)
    monkeypatch.setattr(hot_keys, "TASK_BYTES", hot_keys.input_bytes(df) / 9)
    large = rl.select_sex(df)
    # the rows are dealt once, by a number that grows with the input, and sorted after that only
    text = plan(large)
    assert text.count("Exchange") == 1 and "hashpartitioning(person_id" in text and ", 9), REPARTITION_BY_NUM" in text
    assert text.count("Sort [person_id") == 1 and text.index("Sort [person_id") < text.index("Exchange")
    assert rows(large) == usual
    assert rl.select_sex(df, persons=df.limit(0)).rdd.getNumPartitions() == 9


def test_persons_to_look_at_spare_the_rows(spark, rows, plan, monkeypatch):
    """Hot persons are found in other rows than those selected from, which are not worked out twice."""
    data = [tuple(row.values()) for row in random_sex_rows(2000, 60)] + [("hot", LATER, "1", "M", "gdppr")] * 2000
    ran = spark.sparkContext.accumulator(0)
    df = sex_rows(spark, data).cache()
    usual = rows(rl.select_sex(df))
    counted = F.udf(lambda sex: ran.add(1) or sex)
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 0)
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 1000)
    made = df.withColumn("sex", counted("sex"))
    split = rl.select_sex(made, persons=df.select("person_id"))
    assert ran.value == 0 and "partial_count(1)" in plan(split)
    assert rows(rl.select_sex(df, persons=df.select("person_id"))) == usual
    # a person taken for hot, or not, without being so has the same rows
    assert rows(rl.select_sex(df, persons=df.select(F.lit("p1").alias("person_id")))) == usual
    assert rows(rl.select_sex(df, persons=df.select("person_id").limit(0))) == usual
    df.unpersist()


def test_source_persons(spark, database, rows):
    keys = ("gdppr_demographics", "hes_apc")
    directory = {key: {"database": database, "table_name": key} for key in keys}
    demographics = spark.createDataFrame([("p", DAY, "E1"), (None, DAY, "E1")], "person_id string, reporting_period_end_date date, lsoa string")
    episodes = spark.createDataFrame([("p", LATER, "E2"), ("q", DAY, "E3")], "PERSON_ID_DEID string, EPISTART date, LSOA11 string")
    rl.save_table(demographics, "gdppr_demographics", directory)
    rl.save_table(episodes, "hes_apc", directory)
    persons = rl.source_persons(spark, "lsoa", directory, methods=["gdppr", "hes_apc"])
    assert rows(persons) == [("p",), ("p",), ("q",)]


def test_a_large_saved_table_is_sorted_after_its_shuffle_only(spark, database, rows, plan, monkeypatch):
    directory = {key: {"database": database, "table_name": key} for key in ("sex_multisource", "sex_individual")}
    rl.save_table(sex_rows(spark, [tuple(row.values()) for row in random_sex_rows(3000, 200)]), "sex_multisource", directory)
    saved = rl.load_table(spark, "sex_multisource", directory)
    usual = rows(rl.select_sex(saved))
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 1)
    text = plan(rl.select_sex(saved))
    assert text.count("Exchange") == 1 and text.rindex("WindowGroupLimit") < text.index("Exchange") < text.index("FileScan")
    rl.build_individual(spark, "sex", directory)
    assert rows(rl.load_table(spark, "sex_individual", directory)) == usual


def test_a_large_shuffle_has_few_pieces_and_no_derived_columns(spark, tmp_path, rows, plan, monkeypatch):
    sex_rows(spark, [tuple(row.values()) for row in random_sex_rows(3000, 200)]).write.parquet(str(tmp_path / "sex"))
    df = spark.read.parquet(str(tmp_path / "sex"))
    usual = rows(rl.select_sex(df))
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 1)
    monkeypatch.setattr(hot_keys, "TASK_BYTES", hot_keys.input_bytes(df) / 1100)
    large = rl.select_sex(df)
    text = plan(large)
    # beyond 200 pieces, a task that writes would hold its whole split
    assert ", 200), REPARTITION_BY_NUM" in text
    assert "standing" in text and "standing" not in text[text.index("Exchange") :]
    assert rows(large) == usual
    assert [hot_keys.tasks_for(size, 4) for size in (0, 9, 800, 4800, 9600)] == [1, 3, 200, 200, 400]


def test_small_areas_from_saved_tables_are_dealt_by_size(spark, database, rows, plan, monkeypatch):
    """From saved source tables to the saved individual table no task gathers a whole split or a share that grows with the input."""
    sources = ["hes_op", "hes_ae"]
    keys = (*sources, "lsoa_multisource", "lsoa_individual")
    directory = {key: {"database": database, "table_name": key} for key in keys}
    for name, date, areas in (("hes_op", "apptdate", 7), ("hes_ae", "arrivaldate", 5)):
        seen = f"date_add(date '2020-01-01', cast(id % 11 as int)) as {date}"
        visits = spark.range(6000).selectExpr("concat('p', id % 900) as person_id", seen, f"concat('E', id % {areas}) as lsoa11")
        rl.save_table(visits, name, directory)

    def built():
        rl.build_multisource(spark, "lsoa", directory, methods=sources)
        rl.build_individual(spark, "lsoa", directory)
        return rows(rl.load_table(spark, "lsoa_individual", directory))

    usual = built()
    assert len(usual) == 900 and any(row[4] == 1 for row in usual)
    table = rl.load_table(spark, "hes_op", directory).select("person_id", "apptdate", "lsoa11")
    saved = rl.load_table(spark, "lsoa_multisource", directory)
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 1)
    monkeypatch.setattr(hot_keys, "DEALT_DISTINCT_BYTES", 1)
    monkeypatch.setattr(hot_keys, "DISTINCT_TASK_BYTES", hot_keys.column_bytes(table) / 5.5)
    monkeypatch.setattr(hot_keys, "TASK_BYTES", hot_keys.input_bytes(saved) / 6.5)
    # a shuffle for each source and one for the selection, with nothing gathered or ranked in the tasks that write them
    long, one = plan(rl.multisource(spark, "lsoa", directory, sources)), plan(rl.select_lsoa(saved))
    assert long.count("Exchange") == long.count("REPARTITION_BY_NUM") == 2 and ", 6), REPARTITION_BY_NUM" in long
    assert not any("HashAggregate" in written.split("FileScan")[0] for written in long.split("Exchange")[1:])
    assert one.count("Exchange") == 1 and ", 7), REPARTITION_BY_NUM" in one
    assert not any(step in one[one.index("Exchange") :] for step in ("WindowGroupLimit", "HashAggregate", "Sort"))
    assert built() == usual
