import pytest

import recordloom as rl
from recordloom.operators import codelists
from recordloom.operators import codelists


@pytest.fixture
def csv(tmp_path):
    def write(text, name="list.csv"):
        path = tmp_path / name
        path.write_bytes(text.encode())
        return str(path)

    return write


def test_codes_stay_text_and_empty_stays_empty(spark, csv, rows):
    path = csv("﻿code,description,status\n007,\"a, b\",\nX1,c,d\n1240581000000104,e,f\n")
    df = rl.read_codelist(spark, path)
    assert df.columns == ["code", "description", "status"]
    assert rows(df) == [("007", "a, b", ""), ("1240581000000104", "e", "f"), ("X1", "c", "d")]
    assert rows(rl.read_codelist(spark, path, ["code", "status"], keep_empty=False))[0] == ("007", None)


def test_lookup_table(spark, csv, rows):
    path = csv("item,price,colour\npen,30,blue\ncup,25,red\n")
    assert rl.lookup_mapping(rl.lookup_table(spark, path, "item", "price")) == {"pen": "30", "cup": "25"}
    listed = rl.lookup_mapping(rl.lookup_table(spark, path, "item", ["price", "colour"]))
    assert listed == {"pen": ["30", "blue"], "cup": ["25", "red"]}
    named = rl.lookup_mapping(rl.lookup_table(spark, path, "item", ["price", "colour"], retain_column_names=True))
    assert named["pen"] == {"price": "30", "colour": "blue"}


def test_lookup_needs_a_unique_key(spark, csv):
    with pytest.raises(ValueError, match="not unique"):
        rl.lookup_table(spark, csv("k,v\n1,a\n1,b\n"), "k", "v")


@pytest.fixture
def coded(spark):
    data = [(1, "X1"), (2, "007"), (3, None), (4, "zzz")]
    return spark.createDataFrame(data, "id int, code string")


@pytest.fixture
def listed(spark):
    return spark.createDataFrame([("X1", "one"), ("007", "seven")], "code string, description string")


def test_match(coded, listed, rows, plan):
    assert rows(rl.match_codelist(coded, listed)) == [("007", 2, "seven"), ("X1", 1, "one")]
    left = rl.match_codelist(coded, listed, how="left")
    assert len(rows(left)) == 4 and left.filter("description is null").count() == 2
    assert rows(rl.match_codelist(coded, listed, how="left_semi"), "id") == [(1,), (2,)]
    assert "BroadcastHashJoin" in plan(rl.match_codelist(coded, listed))
    with pytest.raises(ValueError, match="join type"):
        rl.match_codelist(coded, listed, how="cross")


def test_large_codelists_are_not_hinted(spark, coded, plan, monkeypatch):
    many = spark.range(100).selectExpr("cast(id as string) as code", "repeat('x', 100) as text")
    assert rl.fits_broadcast(many)
    assert not rl.fits_broadcast(many, max_rows=99)
    assert not rl.fits_broadcast(many, max_characters=1000)
    joined = rl.match_codelist(coded, many, small=False)
    # the list itself is not hinted; the only hint is on the key filter, whose size is known
    assert joined._jdf.queryExecution().logical().toString().count("ResolvedHint") == 1
    assert "hint" not in rl.match_codelist(coded, many, how="left", small=False)._jdf.queryExecution().logical().toString().lower()


def test_packaged_lists(spark):
    sizes = {"antigen_tests": 6, "infection_snomed": 41, "ethnicity_categories": 21, "ethnicity_pre_2003": 10}
    for name, size in sizes.items():
        df = rl.packaged_codelist(spark, name)
        assert df.count() == size == df.select("code").distinct().count()
    with pytest.raises(ValueError):
        rl.packaged_codelist(spark, "unknown")
    assert codelists.BROADCAST_ROWS > max(sizes.values())


def test_pre_2003_categories():
    from recordloom.sources.codelist_values import PRE_2003_CATEGORY

    assert "".join(PRE_2003_CATEGORY[str(i)] for i in range(10)) == "AMNPHJKRSZ"


def test_doubled_quotes(spark, csv, rows):
    path = csv('code,description\n001,"a ""quoted"" text, more"\n002,"two\nlines"\n003,NA\n')
    assert rows(rl.read_codelist(spark, path)) == [("001", 'a "quoted" text, more'), ("002", "two\nlines"), ("003", "NA")]


def test_a_large_codelist_filters_before_the_shuffle(spark, rows, plan, monkeypatch):
    df = spark.range(4000).selectExpr("concat('c', id % 1000) as code", "id").unionByName(spark.createDataFrame([(None, -1)], "code string, id bigint"))
    codes = spark.range(0, 3000, 30).selectExpr("concat('c', id) as code", "concat('text ', id) as text").unionByName(spark.createDataFrame([(None, "none")], "code string, text string"))
    for how in ("inner", "left", "left_semi"):
        small, large = (rl.match_codelist(df, codes, how=how, small=s) for s in (True, False))
        assert rows(large) == rows(small) and large.columns == small.columns
        text = plan(rl.match_codelist(df, codes, how=how, small=False))
        assert ("bit_or" in text) == (how != "left")
    filtered = codelists.key_filter(df, codes, "code")
    assert filtered.count() == 136 and "bit_or" in plan(filtered)
    # a full map lets rows pass, and loses none
    monkeypatch.setattr(codelists, "FILTER_WORDS", 1)
    assert rows(rl.match_codelist(df, codes, small=False)) == rows(rl.match_codelist(df, codes, small=True))


def test_keys_of_different_types_are_not_filtered(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "code int")
    codes = spark.createDataFrame([("01",), ("3",)], "code string")
    assert rows(rl.match_codelist(df, codes, small=False)) == rows(rl.match_codelist(df, codes, small=True)) == [(1,)]
