"""Run the registered queries against their oracles: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.queries import ORACLES, QUERIES


def local_session(cores: str = "8", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("recordloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # One machine only, so a folder of its own serves as warehouse and scratch space.
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="recordloom-warehouse-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted([tuple(row[i] for i in order) for row in result.fetchall()], key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(row) for row in df.select(*names).collect()), key=repr)


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations"
    ).split():
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, connection, failed = local_session(), connect(sf_dir), []
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = spark_rows(df)
            expected = oracle_rows(connection, ORACLES[name]) if name in ORACLES else got
            good = got == expected
            note = "" if good else f"{got[0]} {expected[0]} {len(got[1])} {len(expected[1])} " + str(
                [p for p in zip(got[1], expected[1]) if p[0] != p[1]][:2]
            )
        except Exception as error:  # reported, and the run goes on
            good, note, got = False, f"{type(error).__name__}: {str(error)[:600]}", ([], [])
        if not good:
            failed.append(name)
        print(f"{'ok  ' if good else 'FAIL'} {name} rows={len(got[1])} {time.time() - start:.2f}s {note}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
