import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import mixing
from recordloom.llm.queries import QUERIES


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 9)), min_size=1, max_size=6), st.integers(0, 40))
def test_apportionment_is_by_highest_quotients(sources, seats):
    weights, limits = [Fraction(w) for w, _ in sources], [n for _, n in sources]
    expected = [0] * len(sources)
    for _ in range(seats):
        best = max(((w / (2 * n + 1), -k) for k, (w, n, most) in enumerate(zip(weights, expected, limits)) if w and n < most), default=None)
        if best is None:
            break
        expected[-best[1]] += 1
    assert mixing.apportion(weights, limits, seats) == expected


def test_targets_stop_at_the_cap_and_the_excess_is_shared():
    sizes, weights = [100, 10, 40, 0], [3, 1, 2, 3]
    targets = mixing.capped_targets(sizes, weights, Fraction(3, 2), 2)
    assert targets == [Fraction(225 - 20 - 80), 20, 80, 0] and sum(targets) == 225
    assert mixing.capped_targets([], [], Fraction(3, 2), 2) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=12), st.integers(0, 5))
def test_pieces_cover_what_the_seats_take(lengths, seed):
    plans = mixing.plan({"a": sum(lengths), None: 30, "b": 500}, shards=5, seed=seed)
    own = plans[0]
    start, taken = 0, 0
    for n in lengths:
        pieces = mixing.stream_pieces(own, start, n)
        assert all(0 <= a < b <= n and 0 <= s < 5 for s, a, b in pieces)
        times = [0] * n
        for _, a, b in pieces:
            times[a:b] = [t + 1 for t in times[a:b]]
        assert all(t <= 2 for t in times)
        taken += sum(times)
        start += n
    if own["size"]:
        full, rest = divmod(own["seats"], own["blocks"])
        edge = lambda k: k * own["size"] // own["blocks"]
        want = full * own["size"] + sum(edge((own["first"] + k) % own["blocks"] + 1) - edge((own["first"] + k) % own["blocks"]) for k in range(rest))
        assert taken == want and abs(taken - own["target"]) <= mixing.BLOCK_TOKENS


def test_query(spark, sf):
    rows = QUERIES["op6_source_mix"](spark, sf).collect()
    again = QUERIES["op6_source_mix"](spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    by_source = {}
    for r in rows:
        assert r["size"] == len(docs[r["doc_id"]]["text"].split()) and 0 <= r["taken"] <= 2 * r["size"]
        by_source.setdefault(docs[r["doc_id"]]["source"], []).append(r)
    total = sum(r["size"] for r in rows)
    for own in by_source.values():
        assert len({(r["source_size"], r["target"]) for r in own}) == 1 and own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= mixing.BLOCK_TOKENS
    assert sum(own[0]["target"] for own in by_source.values()) == pytest.approx(1.5 * total)


def test_a_hot_source_in_many_parts(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_PART", 40)
    draw = random.Random(2)
    texts = ["w " * draw.randrange(50) for _ in range(900)]
    docs = make_docs(texts, ["hot" if k % 3 else f"s{k % 7}" for k in range(900)])
    found = mixing.mix(docs).collect()
    sums = {}
    for r in found:
        own = sums.setdefault((r["source_size"], r["target"]), [0])
        own[0] += r["taken"]
    assert all(abs(taken - target) <= 16 for (_, target), (taken,) in sums.items())
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2


def test_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_rows_of_one_id_are_spread(spark, monkeypatch):
    from pyspark.sql import functions as F

    from recordloom.llm import mixing

    monkeypatch.setattr(mixing, "ROWS_PER_PART", 50)
    docs = spark.range(800).selectExpr("if(id % 2 = 0, null, 7L) as doc_id", "concat('text number ', id) as text", "'s' as source")
    rows = docs.select(F.lit("+s").alias("key"), "doc_id", F.xxhash64("text").alias("text_hash"), F.lit(3).cast("long").alias("size"))
    placed = mixing.stream_offsets(rows, 800, 7)
    assert [r["start"] for r in placed.orderBy("start").collect()] == list(range(0, 2400, 3))
    assert sum(r["taken"] for r in mixing.mix(docs).collect()) in range(3590, 3620)
