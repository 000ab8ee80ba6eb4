import pytest
from pyspark.sql import functions as F

import recordloom as rl


def test_melt(spark, rows):
    df = spark.createDataFrame([(1, "A", 10, 100), (2, "B", 20, None)], "ID int, Category string, V1 int, V2 int")
    long = rl.melt(df, ("ID", "Category"), (c for c in ["V1", "V2"]))
    assert long.columns == ["ID", "Category", "variable", "value"]
    assert rows(long) == [(1, "A", "V1", 10), (1, "A", "V2", 100), (2, "B", "V1", 20), (2, "B", "V2", None)]


def test_melt_of_mixed_types_as_text(spark, rows):
    df = spark.createDataFrame([(1, "x", 2)], "id int, a string, b int")
    assert rows(rl.melt(df, ["id"], ["a", "b"], "k", "v", as_string=True)) == [(1, "a", "x"), (1, "b", "2")]


@pytest.mark.parametrize(
    "names, expected",
    [
        (["Größe", "2nd Value?", "2nd-value "], ["größe", "_2nd_value_", "_2nd_value__2"]),
        (["a", "a", "a"], ["a", "a_2", "a_3"]),
        (["a", "a", "a_2"], ["a", "a_2", "a_2_2"]),
        (["a_2", "a", "A"], ["a_2", "a", "a_3"]),
        (["", "x y"], ["_", "x_y"]),
    ],
)
def test_clean_column_names(spark, names, expected):
    df = spark.range(1).select(*[F.lit(i).alias(f"c{i}") for i in range(len(names))]).toDF(*names)
    assert rl.clean_column_names(df).columns == expected


def test_map_values(spark, rows):
    df = spark.createDataFrame([("A",), ("B",), ("D",), (None,)], "c string")
    mapping = {"A": "Apple", "B": "Banana"}
    assert rows(rl.map_values(df, mapping, "c", "m")) == [
        ("A", "Apple"),
        ("B", "Banana"),
        ("D", None),
        (None, None),
    ]
    assert rl.map_values(df, mapping, "c").columns == ["c"]


def test_large_mapping_is_joined(spark, rows, plan):
    df = spark.createDataFrame([("7",), ("500",), (None,)], "c string")
    mapped = rl.map_values(df, {str(i): i * i for i in range(300)}, "c", "m")
    assert rows(mapped) == [("500", None), ("7", 49), (None, None)]
    assert "BroadcastHashJoin" in plan(mapped)


@pytest.mark.parametrize("value", [lambda i: i, lambda i: i if i else 2.5, lambda i: None, lambda i: {"n": i, "t": str(i)}, lambda i: [i]])
def test_type_does_not_depend_on_size(spark, value):
    df = spark.createDataFrame([("7",)], "c string")
    few, many = (rl.map_values(df, {str(i): value(i) for i in range(n)}, "c", "m") for n in (100, 101))
    assert few.schema == many.schema
    assert few.collect() == many.collect()


def test_lookup_table_of_other_keys_as_mapping(spark, rows, tmp_path):
    path = str(tmp_path / "lookup")
    spark.createDataFrame([("1", "one", "I"), ("2", "two", "II")], "k string, name string, roman string").coalesce(1).write.option("header", True).csv(path)
    lookup = rl.lookup_table(spark, path, "k", ["name", "roman"], True, key_type="int")
    df = spark.createDataFrame([(1,), (3,)], "c int")
    by_table = rl.map_values(df, lookup, "c", "m")
    assert rows(by_table.select("c", "m.roman")) == [(1, "I"), (3, None)]
    assert rows(rl.map_values(df, rl.lookup_mapping(lookup), "c", "m").select("c", "m.name")) == [(1, "one"), (3, None)]


def test_mapping_is_checked(spark):
    df = spark.createDataFrame([("A", 1)], "c string, d int")
    with pytest.raises(ValueError, match="does not exist"):
        rl.map_values(df, {"A": "x"}, "z")
    with pytest.raises(ValueError, match="empty"):
        rl.map_values(df, {}, "c")
    with pytest.raises(ValueError, match="already exists"):
        rl.map_values(df, {"A": "x"}, "c", "d")


def test_recode_keeps_other_values_and_reaches_numbers(spark, rows):
    df = spark.createDataFrame([(0,), (1,), (5,), (None,)], "c int")
    assert rows(rl.recode(df, {"0": None, "1": "M"}, "c", "r")) == [(0, None), (1, "M"), (5, "5"), (None, None)]
