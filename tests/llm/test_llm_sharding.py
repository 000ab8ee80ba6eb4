import zlib

import pytest
from pyspark.sql import functions as F

from recordloom.llm import sharding
from recordloom.llm.queries import QUERIES


def check_law(rows, shards, largest):
    total = {}
    slots = {}
    for shard, slot, size in rows:
        total[shard] = total.get(shard, 0) + size
        slots.setdefault(shard, []).append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(total) <= set(range(shards))
    if len(rows) > 10 * shards:
        assert max(total.values()) - min(total.values()) <= 2 * largest


def test_query(spark, sf):
    rows = QUERIES["op4_splitter_shards"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    check_law([(r["shard"], r["slot"], r["size"]) for r in rows], 24, max(r["size"] for r in rows))


@pytest.mark.parametrize("rows", [1, 7, 3000])
def test_a_third_of_all_rows_are_copies(spark, rows):
    text = F.when(F.col("id") % 3 == 0, F.lit("copy " * 20)).otherwise(F.concat(F.lit("text "), F.col("id")))
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit(1).alias("shard"))
    got = sharding.shard(docs.repartition(5), 8)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    check_law([(r["shard"], r["slot"], len(r["text"]) + 8) for r in got.collect()], 8, 108)
    again = sharding.shard(docs.repartition(2), 8)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "OVERSAMPLING", 1)
    monkeypatch.setattr(sharding, "OVERFULL", 1.2)
    keys = spark.range(4000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("key"), F.lit(10).cast("long").alias("size"))
    boundaries, found = sharding.splitters(keys, 40_000, 64)
    assert len(boundaries) >= 64 and found["rows"].sum() == 4000 and found["rows"].max() < 400


@pytest.mark.parametrize("last", [8, 1000, 2000])
def test_a_small_last_row_of_a_large_table_is_in_the_last_shard(spark, last):
    sizes = F.when(F.col("id") < 300, F.lit(100_000_000)).otherwise(F.lit(last)).cast("long")
    rows = spark.range(301).select(F.col("id").alias("doc_id"), F.col("id").alias("key"), sizes.alias("size"))
    got = {r["doc_id"]: r["shard"] for r in sharding.assign(rows, 24).collect()}
    total = 300 * 100_000_000 + last
    middle = lambda k: 2 * k * 100_000_000 + (100_000_000 if k < 300 else last)
    assert got == {k: middle(k) * 24 // (2 * total) for k in range(301)}
    assert got[300] == 23


def test_odd_rows(odd_docs, no_docs):
    got = sharding.shard(odd_docs, 4)
    assert got.count() == odd_docs.count()
    assert got.columns == [c for c in odd_docs.columns if c != "slot"] + ["shard", "slot"]
    check_law([(r["shard"], r["slot"], len((r["text"] or "").encode()) + 8) for r in got.collect()], 4, 1 << 40)
    assert sharding.shard(no_docs, 4).count() == 0
