import hashlib
import random

import pytest
from brute import without_repeats

from recordloom.llm import span_dedup as s
from recordloom.llm.queries import QUERIES


def corpus(draw, n):
    passages = ["".join(draw.choices("abcdefgh é\n", k=draw.randrange(60, 260))) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = [draw.choice(passages) if draw.random() < 0.5 else "".join(draw.choices("abcdefghij ", k=draw.randrange(0, 180))) for _ in range(draw.randrange(0, 6))]
        if draw.random() < 0.1:
            parts.append("ab" * draw.randrange(0, 200))
        text = "".join(parts)
        if text and draw.random() < 0.3:
            k = draw.randrange(len(text))
            text = text[:k] + "#" + text[k + 1 :]
        texts.append(text)
    return texts + texts[: n // 5]


def collected(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("many", [20_000, 2])
def test_agrees_with_brute_force(make_docs, monkeypatch, many):
    monkeypatch.setattr(s, "MANY_CONTEXTS", many)
    texts = corpus(random.Random(many), 70)
    got = s.without_repeats(make_docs(texts).repartition(4))
    assert collected(got) == without_repeats(list(enumerate(texts)), 100)
    for r in got.collect():
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert collected(QUERIES["op9_earlier_spans"](spark, sf)) == without_repeats(rows, 100)


def test_odd_rows(odd_docs, no_docs):
    rows = s.without_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"]))
    base = by_id[4][0][0]
    # the null id comes first, so its text is the original and all later copies go
    assert by_id[4] == [(base, base)] * 3 and sorted(by_id[None]) == [(0, 0), (base, 0)]
    assert by_id[6] == [(base + 5, base)] and by_id[0] == [(0, 0)] and by_id[3] == [(1, 0)]
    assert s.without_repeats(no_docs).count() == 0


def test_rows_of_one_id_are_told_apart_by_more_than_a_32_bit_hash(spark):
    from pyspark.sql import functions as F

    texts = ["text number 157315", "text number 81052"]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(5, t) for t in texts], "doc_id bigint, text string")
    assert docs.select(F.hash("text")).distinct().count() == 1
    got = s.without_repeats(docs, length=100).collect()
    want = [(k, len(t), 0, 0, hashlib.sha256(t.encode()).hexdigest(), t.encode()) for k in (None, 5) for t in texts]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((*w[:5], bytearray(w[5])) for w in want), key=repr)
