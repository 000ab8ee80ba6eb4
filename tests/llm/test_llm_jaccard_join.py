import random

import numpy as np
import pytest
from brute import jaccard_components

from recordloom.llm import jaccard_join as j
from recordloom.llm.components import components
from recordloom.llm.queries import QUERIES
from recordloom.llm.signature_tree import Threshold, linked_groups, shared_tokens


def corpus(draw, n):
    """Families of near copies, copies, passages that many share, and texts of their own."""
    passage = [f"p{k}" for k in range(25)]
    families = [[f"f{f}x{draw.randrange(80)}" for _ in range(draw.randrange(5, 70))] for f in range(6)]
    texts = []
    for _ in range(n):
        kind = draw.random()
        if kind < 0.6:
            words = list(draw.choice(families))
            for _ in range(draw.randrange(0, 1 + len(words) // 12)):
                words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
        elif kind < 0.9:
            words = [f"u{draw.randrange(10**6)}" for _ in range(draw.randrange(0, 60))]
            words[len(words) // 2 : len(words) // 2] = passage if draw.random() < 0.5 else []
        else:
            words = draw.choice(["", "one", "two words", "The SAME four words"]).split()
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_agrees_with_brute_force(make_docs, monkeypatch, small):
    if small:  # every block and every meeting is split
        for name, value in (("BLOCK_SETS", 3), ("PART_NODES", 2), ("FREQUENT_COUNT", 1), ("SAMPLED", 2)):
            monkeypatch.setattr(j, name, value)
    texts = corpus(random.Random(11 + small), 260)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in j.linked_documents(make_docs(texts).repartition(3), words_per_gram=4, percent=85).collect()}
    assert got == jaccard_components(list(enumerate(texts)), 4, 85)


def test_query(spark, sf):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op7_jaccard_components"](spark, sf).collect()}
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got == jaccard_components(rows, 4, 85)


def test_groups_by_dual_traversal():
    draw = np.random.default_rng(1)
    threshold = Threshold(80)
    bases = [np.unique(draw.integers(0, 1 << 62, 60)).astype(np.uint64) for _ in range(9)]
    sets = []
    for _ in range(150):
        base = bases[draw.integers(9)]
        sets.append(np.unique(np.concatenate([draw.permutation(base)[: 60 - draw.integers(0, 14)], draw.integers(0, 1 << 62, draw.integers(0, 5)).astype(np.uint64)])))
    labels = linked_groups(sets, threshold)
    expected = np.arange(150)
    for a in range(150):
        alike = np.flatnonzero(threshold.alike(shared_tokens(sets[a], sets), len(sets[a]), np.array([len(s) for s in sets])))
        hit = np.isin(expected, expected[alike])
        expected[hit] = expected[hit].min()
    assert (labels == expected).all()


def test_prefixes_share_enough():
    draw = random.Random(4)
    threshold = Threshold(80)
    for _ in range(300):
        n = draw.randrange(1, 120)
        a = set(draw.sample(range(10**6), n))
        b = set(draw.sample(sorted(a), n - draw.randrange(0, n // 6 + 1))) | set(draw.sample(range(10**6), draw.randrange(0, n // 9 + 1)))
        if 100 * len(a & b) >= 80 * len(a | b):
            first = [set(sorted(s)[: threshold.prefix(len(s)) + j.least_shared(len(s)) - 1]) for s in (a, b)]
            assert len(first[0] & first[1]) >= 1 + -(-n * 80 // 100) // j.SHARED_SHARE


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)] + [(700, k) for k in range(701, 760)]
    label = {k: k for pair in links for k in pair}
    for _ in range(70):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: c for k, c in label.items() if k != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = j.linked_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert found[0] == (0, 0) and found[1] == (0, 1) and found[3] == (1, 3)
    assert found[5][1] == found[6][1] == found[9][1] == 4 and found[8][1] == 7
    kept = j.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 1, 2, 3, 4, 7, 10]
    assert j.linked_documents(no_docs).count() == 0 and j.one_of_each(no_docs).count() == 0


def test_rows_of_one_id_keep_a_row_for_each_component(spark):
    draw = random.Random(5)
    first, second = (" ".join(f"{c}{draw.randrange(10_000)}" for _ in range(80)) for c in "ab")
    rows = [(1, first), (1, second), (1, first + " end"), (1, first), (2, first), (3, second + " end"), (1, ""), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for parts in (1, 5):
        kept = [tuple(r) for r in j.one_of_each(docs.repartition(parts)).collect()]
        assert len(kept) == 4 and {(1, second), (1, ""), (1, None)} < set(kept)
        assert len({(1, first), (1, first + " end")} & set(kept)) == 1


def test_columns_of_a_caller_keep_their_values(spark):
    text = " ".join(f"w{k}" for k in range(40))
    names = ["__text_hash", "row", "id", "hash", "group", "n", "component_id"]
    docs = spark.createDataFrame([(k, text if k < 3 else f"other {k}", *[10 * k + n for n in range(len(names))]) for k in range(5)], "doc_id bigint, text string, " + ", ".join(f"`{n}` bigint" for n in names))
    kept = j.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(r) for r in docs.collect() if r["doc_id"] in (0, 3, 4))
