"""The registered queries against their oracles, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as driver
from checks.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not mounted")


@pytest.fixture(scope="module")
def duck():
    from checks.compare import connect

    return connect(SF_DIR)


def test_contract():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    from checks.compare import oracle_rows, spark_rows

    assert spark_rows(driver.queries()[name](spark, SF_DIR)) == oracle_rows(duck, driver.oracle_sql()[name])
