import pytest

import recordloom as rl


@pytest.fixture
def counts(spark):
    return spark.createDataFrame([(1, 7), (2, 17), (3, None)], "id int, n long")


def test_round_counts(counts, rows):
    rounded = rl.round_counts(counts, ["n"], 5)
    assert rows(rounded) == [(1, 5), (2, 15), (3, None)]
    assert rounded.schema["n"].dataType.simpleString() == "bigint"


def test_rounding_halves_and_repeats(spark, rows):
    df = spark.createDataFrame([(5,), (15,), (25,), (-5,)], "n int")
    once = rl.round_counts(df, ["n"], 10)
    assert rows(once) == [(-10,), (10,), (20,), (30,)]
    assert rows(rl.round_counts(once, ["n"], 10)) == rows(once)


def test_redaction(counts, rows):
    assert rows(rl.redact_low_counts(counts, ["n"], 10)) == [(1, None), (2, 17), (3, None)]
    assert rows(rl.redact_low_counts(counts, ["n"], 10, 0)) == [(1, 0), (2, 17), (3, 0)]
    text = rl.redact_low_counts(counts, ["n"], 10, "[:REDACTED:]")
    assert rows(text) == [(1, "[:REDACTED:]"), (2, "17"), (3, "[:REDACTED:]")]


def test_no_low_count_survives(spark):
    df = spark.range(-5, 50).selectExpr("id as n")
    assert rl.redact_low_counts(df, ["n"], 10).filter("n < 10").count() == 0


def test_arguments_are_checked(counts):
    for multiple in (0, -5, 2.5, True):
        with pytest.raises(ValueError):
            rl.round_counts(counts, ["n"], multiple)
    with pytest.raises(ValueError):
        rl.redact_low_counts(counts, ["n"], 0)
    for operator, argument in ((rl.round_counts, 5), (rl.redact_low_counts, 5)):
        with pytest.raises(TypeError):
            operator(counts, "n", argument)
        with pytest.raises(ValueError):
            operator(counts, ["missing"], argument)
