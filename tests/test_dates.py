import datetime as dt

import pytest
from pyspark.sql import functions as F

import recordloom as rl

BASE = dt.date(2020, 6, 1)


@pytest.fixture
def one(spark):
    return spark.sql("select date '2020-06-01' as x, date '2020-06-01' as index_date, timestamp '2020-06-01 10:00' as t")


@pytest.mark.parametrize(
    "text, days",
    [
        ("index_date + 5 days", 5),
        ("x - 6 weeks", -42),
        ("index_date + 3 months", 90),
        ("index_date - 2 years", -731),
        ("index_date", 0),
        ("x - 7.5 weeks", -53),
        ("x + 1 week - 2 days", 5),
        ("t + 5 days", 5),
        ("greatest(x + 5 days, x + 1.5 days)", 5),
        ("least(x + 5 days, x + 1.5 days)", 2),
        ("date_add(x, 2 weeks)", 14),
    ],
)
def test_shifted(one, text, days):
    assert one.select(rl.date_bound(text)).first()[0] == BASE + dt.timedelta(days=days)


def test_literals(one):
    assert one.select(rl.date_bound("2020-01-01")).first()[0] == dt.date(2020, 1, 1)
    assert one.select(rl.date_bound("2020-01-01 + 5 days")).first()[0] == dt.date(2020, 1, 6)
    assert one.select(rl.date_bound(None)).first()[0] is None
    assert one.select(rl.date_bound("current_date() + 1 day") > F.current_date()).first()[0]


@pytest.mark.parametrize("text", ["2020-02-30", "2020-13-01 + 1 day", "2020-01-01x"])
def test_impossible_dates(spark, text):
    with pytest.raises(ValueError, match="Invalid date"):
        rl.date_bound(text)


def test_within_dates(spark, rows, plan):
    df = spark.sql("select date_add(date '2020-01-01', cast(id as int)) as d, date '2020-01-03' as e from range(6)")
    assert rl.within_dates(df, "d").count() == 6
    assert rl.within_dates(df, "d", "2020-01-02", "2020-01-04").count() == 3
    assert rl.within_dates(df, "d", "e - 1 day", dt.date(2020, 1, 3)).count() == 2
    assert rl.within_dates(df, "d", maximum=F.col("e")).count() == 3


def test_literal_bounds_reach_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "dates")
    spark.sql("select date_add(date '2020-01-01', cast(id as int)) as d, id from range(6)").write.parquet(path)
    text = plan(rl.within_dates(rl.require(spark.read.parquet(path), ["id"]), "d", "2020-01-01 + 1 day"))
    assert "GreaterThanOrEqual(d,2020-01-02)" in text and "IsNotNull(id)" in text


@pytest.mark.parametrize(
    "age, completed, days", [(0.5, False, 183), (1, False, 548), (0, True, 183), (0, False, 0), (40, False, 14793)]
)
def test_dob_from_age(spark, age, completed, days):
    df = spark.createDataFrame([(BASE, float(age))], "d date, age double")
    born = df.select(rl.dob_from_age(F.col("d"), F.col("age"), completed)).first()[0]
    assert born == BASE - dt.timedelta(days=days)


def test_unreadable_values_become_null(spark):
    df = spark.createDataFrame([("20201399",), ("x20200101",), ("20200101",), (None,)], "t string")
    parsed = df.select(rl.parsed_date(F.col("t"), "yyyyMMdd", r"\d{8}")).collect()
    assert [row[0] for row in parsed] == [None, None, dt.date(2020, 1, 1), None]
    stamp = spark.sql("select '20210102T03040500' as t").select(
        rl.parsed_timestamp(F.col("t"), "yyyyMMdd'T'HHmmssSS").cast("string")
    )
    assert stamp.first()[0] == "2021-01-02 03:04:05"


def test_seeded_order_ignores_partitioning(spark):
    df = spark.range(500).selectExpr("id % 50 as g", "id as v")

    def drawn(frame):
        order = [rl.seeded_order(3, F.col("g"), F.col("v")), "v"]
        return sorted(tuple(r) for r in rl.first_row(frame, 1, "g", order).collect())

    assert drawn(df.repartition(1)) == drawn(df.repartition(7, "v"))
    assert drawn(df) != sorted((g, g) for g in range(50))
