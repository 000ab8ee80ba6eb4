import datetime as dt

import pytest

import recordloom as rl
from recordloom.operators import hot_keys
from recordloom.sources.extracts import scans

DAY = dt.date(2020, 1, 1)


def extracted(spark, asset, source, data, columns, codelists=None):
    return rl.extract(spark.createDataFrame(data, columns), rl.ASSETS[asset], source, codelists)


@pytest.mark.parametrize(
    "source, date, expected",
    [
        ("gdppr", "reporting_period_end_date", [None, "M", "F", "3", "I", "X", "M", "F"]),
        ("hes_apc", "epistart", [None, "M", "F", "I", "I", None, "M", "F"]),
        ("hes_ae", "arrivaldate", [None, "M", "F", "I", "I", None, "M", "F"]),
        ("hes_op", "apptdate", [None, "M", "F", "3", "I", None, "M", "F"]),
    ],
)
def test_sex_codes(spark, source, date, expected):
    codes = ["0", "1", "2", "3", "9", "X", "M", "F"]
    data = [(f"p{i}", DAY, code) for i, code in enumerate(codes)] * 2
    df = extracted(spark, "sex", source, data, f"person_id string, {date} date, sex string")
    assert df.schema.simpleString() == rl.ASSETS["sex"].schema.simpleString()
    assert [row["sex"] for row in df.orderBy("person_id").collect()] == expected


def test_numeric_codes_are_recoded(spark, rows):
    df = extracted(spark, "sex", "hes_apc", [("p", DAY, 1)], "person_id string, epistart date, sex int")
    assert rows(df, "sex_code", "sex", "data_source") == [("1", "M", "hes_apc")]


def test_unusable_and_repeated_rows_are_dropped(spark, rows):
    data = [("p", DAY, "E1"), ("p", DAY, "E1"), (None, DAY, "E1"), ("p", None, "E1"), ("p", DAY, None)]
    df = extracted(spark, "lsoa", "hes_op", data, "person_id string, apptdate date, lsoa11 string")
    assert rows(df) == [("p", DAY, "E1", "hes_op")]


def test_date_of_birth_texts(spark, rows):
    data = [("a", DAY, "031980"), ("b", DAY, "bad"), ("c", DAY, "991980"), ("d", DAY, None)]
    for source, date in (("hes_apc", "epistart"), ("vaccine_status", "recorded_date")):
        df = extracted(spark, "date_of_birth", source, data, f"person_id string, {date} date, mydob string")
        assert rows(df) == [("a", DAY, dt.date(1980, 3, 1), source)]


def test_date_of_birth_from_age(spark, rows):
    data = [("a", DAY, 0.5), ("a", DAY, 0.501), ("b", DAY, 1.0), ("c", DAY, None)]
    df = extracted(spark, "date_of_birth", "hes_op", data, "person_id string, apptdate date, apptage_calc double")
    # The distinct is on the age, so two ages may give the same date of birth twice.
    assert rows(df, "person_id", "date_of_birth") == [
        ("a", DAY - dt.timedelta(183)),
        ("a", DAY - dt.timedelta(183)),
        ("b", DAY - dt.timedelta(548)),
    ]
    stroke = [("a", dt.datetime(2020, 1, 1, 5), 0)]
    columns = "person_id string, s1firstarrivaldatetime timestamp, s1ageonarrival int"
    df = extracted(spark, "date_of_birth", "ssnap", stroke, columns)
    assert rows(df, "record_date", "date_of_birth") == [(DAY, DAY - dt.timedelta(183))]


def test_ethnicity_before_2003(spark):
    data = [(f"p{code}", DAY, code) for code in "0123456789AXQ"]
    df = extracted(spark, "ethnicity", "hes_apc", data, "person_id string, epistart date, ethnos string")
    found = {row["ethnicity_raw_code"]: row for row in df.collect()}
    assert "".join(found[str(i)]["ethnicity_18_code"] for i in range(10)) == "AMNPHJKRSZ"
    assert found["0"]["ethnicity_raw_description"] == "White" and found["0"]["ethnicity_18_group"] == "British"
    assert found["7"]["ethnicity_5_group"] == "Asian or Asian British"
    assert found["Q"]["ethnicity_18_code"] == "Q" and found["Q"]["ethnicity_5_group"] is None


@pytest.fixture
def snomed(spark):
    data = [("111", "one", "A"), ("222", "two", "Z"), ("222", "two", "Z")]
    return {"ethnicity_snomed": spark.createDataFrame(data, "code string, description string, ethnic_category string")}


def test_ethnicity_from_codes(spark, rows, snomed):
    none, other = dt.date(1899, 12, 30), dt.date(2021, 5, 5)
    data = [
        ("a", other, DAY, "111"),
        ("b", other, none, "111"),
        ("c", other, None, "222"),
        ("d", None, none, "111"),
        ("e", other, DAY, "999"),
    ]
    df = extracted(
        spark, "ethnicity", "gdppr_snomed", data, "person_id string, date date, record_date date, code string", snomed
    )
    assert rows(df, "person_id", "record_date", "ethnicity_raw_description", "ethnicity_18_group") == [
        ("a", DAY, "one", "British"),
        ("b", other, "one", "British"),
        ("c", other, "two", "Not stated"),
    ]


def test_codelist_texts_are_not_shuffled(spark, snomed, plan):
    df = extracted(
        spark,
        "ethnicity",
        "gdppr_snomed",
        [("a", DAY, DAY, "111")],
        "person_id string, date date, record_date date, code string",
        snomed,
    )
    text = plan(df)
    exchange = next(line for line in text.splitlines() if "Exchange hashpartitioning(person_id" in line)
    assert "description" not in exchange and text.count("BroadcastHashJoin") == 2


def test_positive_tests(spark, rows):
    lists = {"antigen_tests": rl.packaged_codelist(spark, "antigen_tests")}
    data = [
        ("a", DAY, "SCT:1240581000000104"),
        ("b", DAY, "SCT:1240591000000102"),
        ("c", DAY, "Positive"),
        ("d", DAY, "Negative"),
        ("e", DAY, "SCT:999"),
        ("f", None, "Positive"),
    ]
    df = extracted(
        spark, "covid_positive", "pillar_2", data, "person_id string, teststartdate date, testresult string", lists
    )
    assert rows(df, "person_id", "code", "covid_status") == [
        ("a", "1240581000000104", "confirmed"),
        ("c", None, "confirmed"),
    ]


def test_columns_without_values_are_typed(spark, rows):
    data = [("a", None, DAY), ("b", None, None)]
    df = extracted(spark, "covid_positive", "sgss", data, "person_id string, specimen_date date, lab_report_date date")
    assert df.schema["code"].dataType.simpleString() == "string"
    assert rows(df) == [("a", DAY, None, None, "confirmed", "sgss")]


@pytest.fixture
def diagnoses(spark):
    data = [("a", DAY, "U071", 1), ("a", DAY, "U071", 2), ("b", DAY, "U071", 2), ("c", DAY, "X1", 1)]
    lists = {"infection_icd10": spark.createDataFrame([("U071", "d", "s")], "code string, description string, covid_status string")}
    return spark.createDataFrame(data, "person_id string, epistart date, code string, diag_position int"), lists


def test_diagnoses_share_one_scan(spark, diagnoses, rows, plan):
    df, lists = diagnoses
    asset, labels = rl.ASSETS["covid_positive"], ["hes_apc_any_diagnosis", "hes_apc_primary_diagnosis"]
    assert labels in scans(asset)
    both = rl.extract(df, asset, labels, lists)
    apart = rl.combine_sources([rl.extract(df, asset, label, lists) for label in labels])
    assert rows(both) == rows(apart)
    assert rows(both, "person_id", "data_source") == [("a", labels[0]), ("a", labels[1]), ("b", labels[0])]


def test_sources_are_checked(spark, diagnoses):
    df, _ = diagnoses
    with pytest.raises(ValueError, match="needs the codelist"):
        rl.extract(df, rl.ASSETS["covid_positive"], "hes_apc_any_diagnosis")
    with pytest.raises(ValueError, match="Invalid extract methods"):
        rl.extract(df, rl.ASSETS["sex"], "vaccine_status")


def test_own_source(spark, database, rows):
    asset = rl.ASSETS["lsoa"].with_source("survey", rl.SourceSpec("survey", {"record_date": "seen", "lsoa": "area"}))
    directory = {"survey": {"database": database, "table_name": "survey"}}
    answers = spark.createDataFrame([("p", DAY, "E1")], "person_id string, seen date, area string")
    rl.save_table(answers, "survey", directory)
    assert rows(rl.multisource(spark, asset, directory, ["survey"])) == [("p", DAY, "E1", "survey")]


def test_filters_reach_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "op")
    data = [("p", DAY, "E1", "x")]
    spark.createDataFrame(data, "person_id string, apptdate date, lsoa11 string, other string").write.parquet(path)
    text = plan(rl.extract(spark.read.parquet(path), rl.ASSETS["lsoa"], "hes_op"))
    assert "PushedFilters: [IsNotNull(person_id), IsNotNull(apptdate), IsNotNull(lsoa11)]" in text
    assert "ReadSchema: struct<person_id:string,apptdate:date,lsoa11:string>" in text


def test_fixed_columns_only(spark):
    for asset in rl.ASSETS.values():
        assert asset.schema.names[0] == "person_id" and asset.schema.names[-1] == "data_source"
        with pytest.raises(ValueError):
            asset.chosen([])


def test_distinct_of_a_large_source_is_dealt_to_tasks_by_size(spark, tmp_path, rows, plan, monkeypatch):
    many = spark.range(4000).selectExpr("concat('p', id % 900) as person_id", "date '2020-01-01' as apptdate", "concat('E', id % 4) as lsoa11")
    equal = spark.range(3000).selectExpr("'hot' as person_id", "date '2020-01-01' as apptdate", "'E1' as lsoa11")
    many.unionByName(equal).write.parquet(str(tmp_path / "hes_op"))
    df = spark.read.parquet(str(tmp_path / "hes_op"))
    usual = rl.extract(df, rl.ASSETS["lsoa"], "hes_op")
    monkeypatch.setattr(hot_keys, "DEALT_DISTINCT_BYTES", 1)
    monkeypatch.setattr(hot_keys, "DISTINCT_TASK_BYTES", hot_keys.column_bytes(df) / 9)
    large = rl.extract(df, rl.ASSETS["lsoa"], "hes_op")
    # one shuffle, to a number of tasks that grows with the input, and nothing gathered before it
    text = plan(large)
    assert text.count("Exchange") == 1 and ", 9), REPARTITION_BY_NUM" in text
    assert "HashAggregate" not in text[text.index("Exchange") :]
    assert rows(large) == rows(usual) and large.count() == 901
    # rows that are repeated very often are combined before their shuffle
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 1000)
    split = rl.extract(df, rl.ASSETS["lsoa"], "hes_op")
    text = plan(split)
    assert "Union" in text and "HashAggregate" in text[text.rindex("Exchange") :]
    assert rows(split) == rows(usual)


def test_distinct_of_a_large_source_has_few_pieces(spark, tmp_path, rows, plan, monkeypatch):
    many = spark.range(4000).selectExpr("concat('p', id % 900) as person_id", "date '2020-01-01' as apptdate", "concat('E', id % 4) as lsoa11")
    many.write.parquet(str(tmp_path / "hes_op"))
    df = spark.read.parquet(str(tmp_path / "hes_op"))
    usual = rows(rl.extract(df, rl.ASSETS["lsoa"], "hes_op"))
    monkeypatch.setattr(hot_keys, "DEALT_DISTINCT_BYTES", 1)
    monkeypatch.setattr(hot_keys, "DISTINCT_TASK_BYTES", hot_keys.column_bytes(df) / 1100)
    large = rl.extract(df, rl.ASSETS["lsoa"], "hes_op")
    assert ", 200), REPARTITION_BY_NUM" in plan(large)
    assert rows(large) == usual
