import datetime as dt
import glob

import pytest

from pyspark.sql import functions as F

import recordloom as rl
from recordloom.sources.tables import stored_versions

DAY = [dt.date(2024, 1, d) for d in (10, 20, 31)]


@pytest.fixture
def versions(spark):
    data = [(i, DAY[i % 3]) for i in range(9)]
    return spark.createDataFrame(data, "id int, archived_on date")


def entry(database, table="t", **more):
    return {"t": {"database": database, "table_name": table, **more}}


@pytest.mark.parametrize("partition_by", [None, "archived_on", ["archived_on"]])
def test_versions_of_a_stored_table(spark, versions, database, rows, partition_by):
    rl.save_table(versions, "t", entry(database), partition_by)
    assert len(rows(rl.load_table(spark, "t", entry(database)))) == 9
    latest = rl.load_table(spark, "t", entry(database, archive_date="latest"))
    assert rows(latest, "id") == [(2,), (5,), (8,)]
    exact = rl.load_table(spark, "t", entry(database, archive_date="2024-01-20"))
    assert rows(exact, "id") == [(1,), (4,), (7,)]
    upper = rl.load_table(spark, "t", entry(database, max_archive_date="2024-01-20"))
    assert len(rows(upper)) == 6
    assert stored_versions(spark, f"{database}.t") == [d.isoformat() for d in DAY]


def test_version_filters_prune_partitions(spark, versions, database, plan):
    rl.save_table(versions, "t", entry(database), "archived_on")
    for version in ("latest", "2024-01-31"):
        text = plan(rl.load_table(spark, "t", entry(database, archive_date=version)))
        assert "PartitionFilters: [isnotnull(archived_on" in text and "2024-01-31" in text


def test_latest_ignores_partitions_without_rows(spark, versions, database, rows):
    rl.save_table(versions, "t", entry(database), "archived_on")
    spark.sql(f"ALTER TABLE {database}.t ADD PARTITION (archived_on = '2025-01-01')")
    latest = rl.load_table(spark, "t", entry(database, archive_date="latest"))
    assert rows(latest, "id") == [(2,), (5,), (8,)]


def test_text_versions(spark, versions, rows):
    text = versions.selectExpr("id", "cast(archived_on as string) as archived_on")
    assert rows(rl.at_version(text, "latest"), "id") == [(2,), (5,), (8,)]
    assert rl.up_to_version(text, "2024-01-10").count() == 3
    assert [r[0] for r in rl.archive_versions(text).collect()] == [d.isoformat() for d in DAY]


def test_saving_replaces_the_schema_and_can_append(spark, database):
    first, second = spark.range(3), spark.range(2).selectExpr("id", "'x' as more")
    rl.save_table(first, "t", entry(database))
    rl.save_table(second, "t", entry(database))
    assert rl.load_table(spark, "t", entry(database)).columns == ["id", "more"]
    rl.save_table(second, "t", entry(database), mode="append")
    assert rl.load_table(spark, "t", entry(database)).count() == 4


def test_entries_are_checked(spark, versions, database):
    with pytest.raises(KeyError, match="unknown"):
        rl.load_table(spark, "unknown", entry(database))
    with pytest.raises(KeyError):
        rl.save_table(versions, "unknown", entry(database))
    with pytest.raises(ValueError, match="Only one"):
        rl.load_table(spark, "t", entry(database, archive_date="latest", max_archive_date="2024-01-01"))
    with pytest.raises(ValueError, match="partition_by"):
        rl.save_table(versions, "t", entry(database), [1])


def test_loading_standardises(spark, database, rows):
    df = spark.createDataFrame([("p1", "x")], "NHS_NUMBER_DEID string, `Some Code` string")
    df = df.toDF("NHS_NUMBER_DEID", "SOME_CODE")
    rl.save_table(df, "t", entry(database))
    assert rl.load_table(spark, "t", entry(database), "gdppr").columns == ["person_id", "some_code"]


def test_export(spark, tmp_path, rows):
    df = spark.range(3).selectExpr("id", "if(id = 1, 'a, b', '') as text")
    path = str(tmp_path / "out")
    rl.export_small_csv(df, path, max_rows=3)
    assert len(glob.glob(f"{path}/part-*.csv")) == 1
    assert rows(rl.read_codelist(spark, path)) == [("0", ""), ("1", "a, b"), ("2", "")]
    with pytest.raises(ValueError, match="More than 2"):
        rl.export_small_csv(df, path, max_rows=2)
    with pytest.raises(ValueError, match="empty"):
        rl.export_small_csv(df.limit(0), path)
    with pytest.raises(ValueError, match="does not exist"):
        rl.export_small_csv(df, str(tmp_path / "missing" / "out"))


def test_standardised_deaths(spark, rows):
    data = [("p1", "20200102", "20200203"), ("p2", "20201399", "bad"), ("p3", "unknown", None)]
    columns = "DEC_CONF_NHS_NUMBER_CLEAN_DEID string, REG_DATE_OF_DEATH string, REG_DATE string"
    df = rl.standardise(spark.createDataFrame(data, columns), "deaths")
    assert df.columns == ["person_id", "date_of_death", "reg_date"]
    assert rows(df) == [
        ("p1", dt.date(2020, 1, 2), dt.date(2020, 2, 3)),
        ("p2", None, None),
        ("p3", None, None),
    ]


def test_standardised_vaccinations(spark):
    columns = "Person_ID_DEID string, RECORDED_DATE string, EXPIRY_DATE string, DATE_AND_TIME string"
    data = [("p", "20210102", "x", "20210102T03040500")]
    row = rl.standardise(spark.createDataFrame(data, columns), "vaccine_status").first()
    assert row["recorded_date"] == dt.date(2021, 1, 2) and row["expiry_date"] is None
    assert row["date_and_time"] == dt.datetime(2021, 1, 2, 3, 4, 5)


@pytest.mark.parametrize("method", sorted(set(rl.STANDARDISE_METHODS) - {"deaths", "vaccine_status", "gdppr"}))
def test_standardised_person(spark, method):
    for delivered in ("PERSON_ID_DEID", "Person_ID_DEID"):
        df = spark.createDataFrame([("p", 1)], f"{delivered} string, x int").toDF(delivered, "Other Column")
        assert rl.standardise(df, method).columns == ["person_id", "other_column"]


def test_own_and_unknown_standards(spark):
    df = spark.createDataFrame([("p", "20200101")], "PID string, Seen string")
    own = rl.Standard({"pid": "person_id"}, dates={"seen": "yyyyMMdd"})
    assert rl.standardise(df, own).first() == ("p", dt.date(2020, 1, 1))
    with pytest.raises(ValueError, match="Unknown method"):
        rl.standardise(df, "unknown")


def test_snapshot_update(spark, database, rows):
    schema = (
        "archived_on date, person_id string, practice string, reporting_period_end_date date, sex string, "
        "lsoa string, ethnic string, year_month_of_birth string, other int"
    )
    data = [
        (DAY[i % 3], None if i % 5 == 0 else f"p{i % 4}", "x", DAY[0], "1", "e", "A", "1990-01", i)
        for i in range(60)
    ]
    source = spark.createDataFrame(data, schema)
    keys = ("gdppr_all_versions", "gdppr_demographics_all_versions")
    directory = {key: {"database": database, "table_name": key} for key in keys}
    expected = rows(rl.summarise_demographics(source))

    rl.save_table(rl.up_to_version(source, "2024-01-10"), keys[0], directory, "archived_on")
    assert rl.update_demographics(spark, directory) == ["2024-01-10"]
    rl.save_table(source, keys[0], directory)
    assert rl.update_demographics(spark, directory) == ["2024-01-20", "2024-01-31"]
    columns = rl.summarise_demographics(source).columns
    assert rows(rl.load_table(spark, keys[1], directory), *columns) == expected
    assert rl.update_demographics(spark, directory) == []
    assert rows(rl.load_table(spark, keys[1], directory), *columns) == expected

    # A changed version already present is kept until everything is rebuilt.
    changed = source.withColumn("practice", source["lsoa"])
    rl.save_table(changed, keys[0], directory)
    assert rl.update_demographics(spark, directory) == []
    assert rows(rl.load_table(spark, keys[1], directory), *columns) == expected
    assert len(rl.update_demographics(spark, directory, update_all=True)) == 3
    assert rows(rl.load_table(spark, keys[1], directory), *columns) == rows(rl.summarise_demographics(changed))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_new_versions(spark, versions):
    missing = rl.new_versions(versions, rl.up_to_version(versions, "2024-01-10"))
    assert sorted(r[0] for r in missing.collect()) == ["2024-01-20", "2024-01-31"]


@pytest.mark.parametrize("partition_by", [None, "part"])
def test_a_failed_overwrite_keeps_the_old_rows(spark, database, rows, partition_by):
    directory = {"t": {"database": database, "table_name": "t"}}
    old = spark.range(6).selectExpr("id", "id % 2 as part")
    rl.save_table(old, "t", directory, partition_by)
    before = rows(rl.load_table(spark, "t", directory), "id", "part")
    fails = spark.range(4000).selectExpr("if(id = 3999, cast(raise_error('midway') as bigint), id) as id", "id % 2 as part")
    with pytest.raises(Exception, match="midway"):
        rl.save_table(fails, "t", directory, partition_by)
    assert rows(rl.load_table(spark, "t", directory), "id", "part") == before
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


@pytest.mark.parametrize("partition_by", [None, "part"])
def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, database, rows, partition_by):
    directory = {"t": {"database": database, "table_name": "t"}}
    rl.save_table(spark.range(6).selectExpr("id", "id % 2 as part"), "t", directory, partition_by)
    for _ in range(2):
        own = rl.load_table(spark, "t", directory)
        assert own.count() == 6  # what the session remembers of the old files must not be used
        rl.save_table(own.selectExpr("id + 10 as id", "'x' as added", "part"), "t", directory, partition_by)
    got = rl.load_table(spark, "t", directory)
    assert rows(got, "id", "added") == [(k + 20, "x") for k in range(6)]
    assert got.filter("part = 1").count() == 3
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_only_changed_versions_are_rebuilt(spark, database, rows):
    names = ["person_id", "practice", "reporting_period_end_date", "sex", "lsoa", "ethnic", "year_month_of_birth"]
    schema = "archived_on date, person_id string, practice string, reporting_period_end_date date, sex string, lsoa string, ethnic string, year_month_of_birth string"
    data = [(DAY[i % 3], f"p{i % 4}", "x", DAY[0], str(i % 2), "e", "A", "1990-01") for i in range(60)]
    keys = ("gdppr_all_versions", "gdppr_demographics_all_versions", "prints")
    directory = {key: {"database": database, "table_name": key} for key in keys}

    def update(df):
        rl.save_table(df, keys[0], directory, "archived_on")
        done = rl.update_demographics(spark, directory, fingerprints="prints")
        got = rl.load_table(spark, keys[1], directory)
        assert rows(got, "archived_on", *names) == rows(rl.summarise_demographics(df), "archived_on", *names)
        return done

    source = spark.createDataFrame(data, schema)
    assert len(update(source)) == 3
    assert update(source.repartition(5).orderBy("sex")) == []  # the order of rows is no change
    second = source["archived_on"] == DAY[1]
    assert update(source.withColumn("sex", F.when(second, "9").otherwise(source["sex"]))) == ["2024-01-20"]
    assert update(source.filter(~second)) == ["2024-01-20"]
    # one row more of an equal one is a change of the version, though not of the snapshot
    assert update(source.filter(~second).unionByName(source.filter(source["archived_on"] == DAY[0]).limit(1))) == ["2024-01-10"]
    assert sorted(update(source)) == ["2024-01-10", "2024-01-20"]
