import random

import numpy as np
from pyspark.sql import functions as F

from recordloom.llm import quality_gam, toxicity
from recordloom.llm.labelled import held_out, training_rows
from recordloom.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.01"


def test_held_out_rows_and_the_bound(spark, make_docs):
    docs = make_docs(["x"] * 200)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).unionByName(spark.createDataFrame([(None, 1), (5, None)], "doc_id bigint, quality int"))
    assert training_rows(docs, labels, ["quality"], 50).count() == 50
    used = training_rows(docs, labels, ["quality"], 1000)
    assert used.count() == labels.where(~held_out(F.col("doc_id"))).where("quality is not null").count()


def test_additive_model_finds_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert ((model.scores(x) > 0.5) == y).mean() > 0.95
    assert any(set(term.columns) == {0, 1} for term in model.terms if len(term.columns) == 2)
    assert (quality_gam.fit(x, np.ones(3000)).scores(x) > 0.9).all() and (quality_gam.fit(x[:0], y[:0]).scores(x) == 0.5).all()


def test_quality_query_on_held_out_rows(spark, sf):
    scored = QUERIES["op10_additive_quality"](spark, TABLES)
    found = scored.join(spark.read.parquet(f"{TABLES}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert scored.count() == 1000 and found["score"].between(0, 1).all()
    assert (found["predicted"] == (found["score"] >= 0.3)).all() and (found["predicted"] == found["quality"]).mean() > 0.9


def test_later_categories_use_earlier_ones():
    draw = random.Random(2)
    sets, y = [], []
    for _ in range(1500):
        a, noise = draw.random() < 0.3, draw.random() < 0.5
        words = {draw.randrange(100, 160) for _ in range(6)} | ({draw.randrange(5)} if a else set()) | ({50} if noise else set())
        sets.append(np.array(sorted(words), np.uint64))
        y.append((int(a), int(a), int(noise)))
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    y = np.array(y)
    chain = toxicity.fit_chain(np.concatenate(sets), first, y, np.arange(1500) % toxicity.FOLDS, ["a", "b", "c"])
    p = chain.probabilities(np.concatenate(sets), first)
    assert ((p > 0.5) == y).mean(axis=0).min() > 0.97
    assert [len(m.dense) for m in chain.models] == [0, 1, 2] and chain.models[1].dense[0] > 0.1


def test_toxicity_query_on_held_out_rows(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumn("low_quality", 1 - F.col("quality"))
    chain = toxicity.train(docs, labels, ["low_quality", "toxic"])
    found = toxicity.predict(docs, chain, flag="toxic").withColumnRenamed("toxic", "flag").join(labels, "doc_id").where(held_out(F.col("doc_id"))).toPandas()
    assert found["flag"][found["toxic"] == 1].mean() > 0.6
    assert found["flag"][found["toxic"] == 0].mean() < 0.01
    assert QUERIES["op1_toxicity_chain"](spark, TABLES).count() == 1000


def test_odd_rows(odd_docs, no_docs):
    labels = odd_docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(1).alias("toxic")).distinct()
    for docs in (odd_docs, no_docs):
        for own in (labels, labels.limit(0)):
            scored = quality_gam.score(docs, quality_gam.train(docs, own)).collect()
            assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
            flagged = toxicity.predict(docs, toxicity.train(docs, own, ["quality", "toxic"]), flag="toxic")
            assert flagged.count() == docs.count()


def test_the_bound_holds_for_documents_and_labels_without_documents_do_not_use_it_up(spark):
    ids = [k for k in range(400) if k % 2 or k > 300]
    docs = spark.createDataFrame([(k, f"text {k}") for k in ids] + [(1, f"other {n}") for n in range(2000)] + [(3, "text 3")] * 2000, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(10_000)], "doc_id bigint, quality int")
    learnt = [k for k in ids if not held_out_plain(k)]
    assert training_rows(docs, labels, ["quality"], 100).count() == 100
    all_rows = sorted(map(tuple, training_rows(docs, labels, ["quality"], 100_000).collect()))
    want = [(f"text {k}", k % 2) for k in learnt] + ([(f"other {n}", 1) for n in range(2000)] if 1 in learnt else [])
    assert all_rows == sorted(want)
    assert training_rows(docs, labels, ["quality"], len(learnt)).count() == len(learnt)


def held_out_plain(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 5 == 0
