import pytest
from pyspark.sql import functions as F

import recordloom as rl
from recordloom.operators import hot_keys


@pytest.fixture
def groups(spark):
    data = [("x", 7), ("x", 7), ("x", 8), ("x", 11), ("y", 2), ("y", 3), ("y", 9)]
    return spark.createDataFrame(data, "`group` string, value int")


@pytest.mark.parametrize(
    "method, expected",
    [
        ("row_number", [("x", 7, 1), ("x", 7, 2), ("y", 2, 1), ("y", 3, 2)]),
        ("rank", [("x", 7, 1), ("x", 7, 1), ("y", 2, 1), ("y", 3, 2)]),
        ("dense_rank", [("x", 7, 1), ("x", 7, 1), ("x", 8, 2), ("y", 2, 1), ("y", 3, 2)]),
    ],
)
@pytest.mark.parametrize("heavy", [False, True])
def test_methods(groups, rows, method, expected, heavy):
    top = rl.top_rows(groups, method, 2, ["group"], ["value"], True, "place", heavy_ties=heavy)
    assert rows(top) == expected
    assert top.columns == ["group", "value", "place"]


def test_wrappers_name_their_index(groups):
    for operator, name in ((rl.first_row, "row_index"), (rl.first_rank, "rank_index")):
        assert operator(groups, 1, "group", "value", return_index_column=True).columns[-1] == name
    dense = rl.first_dense_rank(groups, 1, "group", "value", return_index_column=True)
    assert dense.columns[-1] == "dense_rank_index"
    assert rl.first_rank(groups, 1, "group", "value").columns == ["group", "value"]


@pytest.mark.parametrize(
    "method, expected",
    [
        ("row_number", [("x", 11, 1), ("y", 9, 2)]),
        ("rank", [("x", 11, 1), ("y", 9, 2)]),
        ("dense_rank", [("x", 11, 1), ("y", 9, 2)]),
    ],
)
@pytest.mark.parametrize("order", ["value desc", F.desc])
def test_whole_table(groups, rows, method, expected, order):
    key = order if isinstance(order, str) else F.col("value").desc()
    assert rows(rl.top_rows(groups, method, 2, order_by=key, return_index_column=True)) == expected


def test_whole_table_ranks_leave_gaps(groups, rows):
    ranked = rl.first_rank(groups, 5, order_by="value", return_index_column=True)
    assert rows(ranked) == [("x", 7, 3), ("x", 7, 3), ("x", 8, 5), ("y", 2, 1), ("y", 3, 2)]
    dense = rl.first_dense_rank(groups, 3, order_by="value", return_index_column=True)
    assert rows(dense) == [("x", 7, 3), ("x", 7, 3), ("y", 2, 1), ("y", 3, 2)]


def test_computed_key_over_whole_table(groups, rows):
    assert rows(rl.first_rank(groups, 1, order_by=F.abs(F.col("value") - 9))) == [("y", 9)]


@pytest.mark.parametrize("heavy", [False, True])
def test_computed_keys_and_groups(groups, rows, heavy):
    order = [(F.col("value") % 4).desc(), "abs(value - 7) asc"]
    got = rl.first_rank(groups, 1, F.upper("group"), order, heavy_ties=heavy)
    assert rows(got) == [("x", 7), ("x", 7), ("y", 3)]


def test_computed_key_leaves_no_rows_to_one_task(groups, plan):
    text = plan(rl.first_rank(groups, 3, order_by=[F.lit(True), F.abs(F.col("value")).desc()]))
    assert "TakeOrderedAndProject" in text and "SinglePartition" not in text


@pytest.mark.parametrize("heavy", [False, True])
def test_null_placement(spark, rows, heavy):
    df = spark.createDataFrame([("A", None), ("A", 1), ("B", None), (None, 2), (None, None)], "g string, v int")
    first = rl.first_rank(df, 1, "g", "v", heavy_ties=heavy)
    assert rows(first) == [("A", None), ("B", None), (None, None)]
    last = rl.first_rank(df, 1, "g", "v asc nulls last", heavy_ties=heavy)
    assert rows(last) == [("A", 1), ("B", None), (None, 2)]
    by_column = rl.first_rank(df, 1, "g", F.col("v").asc_nulls_last(), heavy_ties=heavy)
    assert rows(by_column) == rows(last)


def test_arguments_are_checked(groups):
    with pytest.raises(ValueError, match="method"):
        rl.top_rows(groups, "ntile", 1, "group", "value")
    for n in (0, -1, 1.5, True):
        with pytest.raises(ValueError, match="positive"):
            rl.first_row(groups, n, "group", "value")
    with pytest.raises(ValueError, match="order_by"):
        rl.first_row(groups, 1, "group")


def test_groups_are_limited_before_the_shuffle(groups, plan):
    text = plan(rl.first_dense_rank(groups, 1, "group", "value"))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1
    assert "Partial" in text


def test_whole_table_needs_no_single_partition_window(groups, plan):
    assert "TakeOrderedAndProject" in plan(rl.first_row(groups, 3, order_by="value"))
    text = plan(rl.first_dense_rank(groups, 3, order_by="value"))
    assert "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text


def test_one_group_with_most_rows_and_ties(spark, rows):
    """Half of all rows tie in one group; the counted way gives the same rows as the window."""
    df = spark.range(20_000).selectExpr("if(id % 2 = 0, 0, id % 50) as g", "if(id % 2 = 0, 1, id % 7) as v", "id")
    plain = rl.first_rank(df, 2, "g", "v", return_index_column=True)
    counted = rl.first_rank(df, 2, "g", "v", return_index_column=True, heavy_ties=True)
    assert rows(plain) == rows(counted) and plain.count() > 10_000


@pytest.mark.parametrize("method", ["rank", "dense_rank"])
def test_hot_groups_are_found_and_split_without_the_callers_help(spark, rows, plan, monkeypatch, method):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, null, id % 700) as g", "cast(id % 5 as string) as v", "id")
    plain = rl.top_rows(df, method, 2, "g", "v desc", True, heavy_ties=False)
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 0)
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 5_000)
    split = rl.top_rows(df, method, 2, "g", "v desc", True)
    assert rows(split) == rows(plain)
    text = plan(split)
    assert text.count("WindowGroupLimit") >= 2 and "HashAggregate" in text and "Union" in text
    # no group is hot: the window alone
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 50_000)
    text = plan(rl.top_rows(df, method, 2, "g", "v desc", True))
    assert "HashAggregate" not in text and "Union" not in text


def test_hot_keys_are_those_with_many_rows(spark, monkeypatch):
    df = spark.range(10_000).selectExpr("if(id % 4 = 0, 'a', concat('k', id % 3000)) as k")
    assert hot_keys.hot_keys(df, ["k"]) == []
    monkeypatch.setattr(hot_keys, "MEASURED_BYTES", 0)
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 1000)
    found = hot_keys.hot_keys(df, ["k"])
    assert df.filter(hot_keys.has_key(["k"], found)).select("k").distinct().collect() == [("a",)]
    assert hot_keys.hot_keys(df.limit(0), ["k"]) == []
