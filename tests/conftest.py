import os
import sys
import tempfile
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from checks.compare import local_session

    warehouse = tempfile.mkdtemp(prefix="recordloom-warehouse-")
    conf = {
        "spark.sql.warehouse.dir": warehouse,
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.maxMetadataStringLength": "4000",
    }
    session = local_session("4", **conf)
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    name = f"test_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples, for comparison without regard to order."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return collect


@pytest.fixture
def plan():
    """Text of the executed plan."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
