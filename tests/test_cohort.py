import pytest

import recordloom as rl

CRITERIA = {"known": "person_id IS NOT NULL", "seen_twice": "visits >= 2"}
CHART = [
    (0, "criteria_0", "Original table", "", 6, 3, None, None),
    (1, "criteria_1", "known", "person_id IS NOT NULL", 4, 3, 2, 0),
    (2, "criteria_2", "seen_twice", "visits >= 2", 3, 2, 1, 1),
]


@pytest.fixture
def cohort(spark):
    data = [("r1", "ann", 1), ("r2", "ben", 3), ("r3", None, 4), ("r4", "cat", 2), ("r5", "cat", 5), ("r6", None, 1)]
    return spark.createDataFrame(data, "row_id string, person_id string, visits int")


def test_filtered(cohort, rows):
    included = rl.apply_inclusion_criteria(cohort, CRITERIA)
    assert included.columns == cohort.columns
    assert rows(included) == [("r2", "ben", 3), ("r4", "cat", 2), ("r5", "cat", 5)]
    flagged = rl.apply_inclusion_criteria(cohort, CRITERIA, drop_inclusion_flags=False)
    assert flagged.columns[3:] == [*CRITERIA, "criteria_0", "criteria_1", "criteria_2", "include"]


def test_flags(cohort, rows):
    flagged = rl.flag_inclusion(cohort, CRITERIA)
    assert rows(flagged, "row_id", *CRITERIA, "criteria_2", "include")[0] == ("r1", True, False, False, False)
    assert rows(flagged, "row_id", *CRITERIA, "criteria_1", "include")[2] == ("r3", False, True, False, False)


def test_flowchart(cohort, rows):
    chart = rl.inclusion_flowchart(rl.flag_inclusion(cohort, CRITERIA), CRITERIA)
    assert rows(chart) == CHART
    assert [f.dataType.simpleString() for f in chart.schema.fields][4:] == ["bigint"] * 4


def test_flowchart_is_saved(spark, cohort, rows, database):
    directory = {"chart": {"database": database, "table_name": "flowchart"}}
    rl.apply_inclusion_criteria(cohort, CRITERIA, "chart", directory=directory)
    assert rows(rl.load_table(spark, "chart", directory)) == CHART


def test_empty_cohort_and_no_criteria(cohort, rows):
    empty = rl.inclusion_flowchart(rl.flag_inclusion(cohort.limit(0), CRITERIA), CRITERIA)
    assert [row[4:6] for row in rows(empty)] == [(0, 0)] * 3
    assert rows(rl.inclusion_flowchart(rl.flag_inclusion(cohort, {}), {})) == CHART[:1]


def test_criteria_may_build_on_each_other(cohort, rows):
    criteria = {"known": "person_id IS NOT NULL", "known_again": "known AND visits >= 2"}
    assert rows(rl.apply_inclusion_criteria(cohort, criteria), "row_id") == [("r2",), ("r4",), ("r5",)]


def test_unknown_counts_as_not_met(spark, rows):
    cohort = spark.createDataFrame([("1", "a", None), ("2", "a", 20)], "row_id string, person_id string, age int")
    assert rows(rl.apply_inclusion_criteria(cohort, {"adult": "age >= 18"}), "row_id") == [("2",)]


def test_arguments_are_checked(cohort):
    with pytest.raises(TypeError, match="dictionary"):
        rl.apply_inclusion_criteria(cohort, ["person_id IS NOT NULL"])
    with pytest.raises(TypeError, match="SQL text"):
        rl.apply_inclusion_criteria(cohort, {"a": 1})
    with pytest.raises(TypeError, match="predicate"):
        rl.apply_inclusion_criteria(cohort, {"a": "visits + 1"})
    for criteria in ({"visits": "visits > 1"}, {"include": "visits > 1"}, {"criteria_1": "visits > 1"}):
        with pytest.raises(ValueError, match="clash"):
            rl.apply_inclusion_criteria(cohort, criteria)
    with pytest.raises(ValueError, match="Missing"):
        rl.apply_inclusion_criteria(cohort, {"a": "visits > 1"}, row_id_col="missing")
    with pytest.raises(ValueError, match="clash"):
        rl.apply_inclusion_criteria(cohort.withColumnRenamed("visits", "criteria_9"), {"a": "true"})


def test_one_hash_exchange_whatever_the_number_of_criteria(cohort, plan):
    for n in (2, 9):
        criteria = {f"c{i}": f"visits > {i}" for i in range(n)}
        text = plan(rl.inclusion_flowchart(rl.flag_inclusion(cohort, criteria), criteria))
        assert text.count("Exchange hashpartitioning") == 1 and text.count("Exchange") == 2
        assert "Window" not in text and "Join" not in text
        # what is shuffled is a key and two numbers, of rows doubled once
        assert "partial_max(deepest" in text and "partial_count(1)" in text and text.count("Expand") == 1


def test_counts_agree_with_the_direct_way(spark):
    cohort = spark.range(5000).selectExpr(
        "id as row_id", "if(id % 3 = 0, null, id % 411) as person_id", "id % 97 as a", "id % 13 as b"
    )
    criteria = {"first": "a > 20", "second": "b < 9", "third": "person_id is not null"}
    flagged = rl.flag_inclusion(cohort, criteria)
    chart = rl.inclusion_flowchart(flagged, criteria).orderBy("criteria_index").collect()
    for line in chart:
        left = flagged.filter(line["criteria"])
        assert line["n_row"] == left.count()
        assert line["n_distinct_id"] == left.select("person_id").dropna().distinct().count()
    assert chart[-1]["n_row"] == rl.apply_inclusion_criteria(cohort, criteria).count()
    assert [c["n_row"] for c in chart] == sorted((c["n_row"] for c in chart), reverse=True)
