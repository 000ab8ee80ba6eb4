import random

import numpy as np
import pyarrow as pa
from brute import edit_distance_inside

from recordloom.llm import decontamination as d
from recordloom.llm.queries import QUERIES


def fold(text):
    return " ".join((text or "").lower().split(" ")) if text else ""


def edited(draw, text, edits):
    out = list(text)
    for _ in range(edits):
        k = draw.randrange(len(out))
        kind = draw.randrange(3)
        if kind == 0:
            out[k] = "x"
        elif kind == 1:
            out.insert(k, "y")
        else:
            del out[k]
    return "".join(out)


def test_alignment_agrees_with_edit_distance():
    draw = random.Random(1)
    for _ in range(300):
        pattern = "".join(draw.choices("abc ", k=draw.randrange(8, 40)))
        text = "".join(draw.choices("abc ", k=draw.randrange(0, 6))) + edited(draw, pattern, draw.randrange(0, 7)) + "".join(draw.choices("abc ", k=draw.randrange(0, 6)))
        p, t = (np.frombuffer(x.encode(), np.uint8) for x in (pattern, text))
        assert d.aligned(p, t, -8, 16, 4) == (edit_distance_inside(pattern, text) <= 4)


def test_passages_within_the_edit_budget_are_found_and_no_others(spark, make_docs):
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefghijklmnop", k=draw.randrange(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [prose(draw.randrange(8, 40)) for _ in range(30)] + ["short", None, ""]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    texts, planted = [], []
    for k in range(160):
        body = prose(draw.randrange(0, 120))
        if k % 2:
            item = draw.randrange(30)
            part = items[item]
            start = draw.randrange(max(1, len(part) - 90))
            part = edited(draw, part[start : start + 90], draw.randrange(0, 9))
            planted.append((k, item))
            body = body + " " + part.upper().replace(" ", " \n ") + " " + prose(5)
        texts.append(body)
    got = {r["doc_id"]: r["item_ids"] for r in d.contamination(make_docs(texts), benchmark).collect()}
    index = d.Index.of(list(range(30)), items[:30])
    for k, text in enumerate(texts):
        data, _ = d.folded(pa.array([text]))
        folded = data.tobytes().decode()
        expected = []
        for item in range(30) if k < 60 else [i for p, i in planted if p == k]:
            own = index.data[index.offsets[item] : index.offsets[item + 1]].tobytes().decode()
            if any(edit_distance_inside(own[s : s + n], folded) <= e for s, n, e in index.segments(item)):
                expected.append(item)
        assert got[k] == expected if k < 60 else set(expected) <= set(got[k])


def test_blocks_of_the_benchmark_give_the_same(spark, sf, monkeypatch):
    whole = sorted((r["doc_id"], r["item_ids"]) for r in QUERIES["op2_benchmark_passages"](spark, sf).collect())
    monkeypatch.setattr(d, "BLOCK_BYTES", 2_000)
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert len(d.benchmark_blocks(benchmark)) > 3
    assert sorted((r["doc_id"], r["item_ids"]) for r in QUERIES["op2_benchmark_passages"](spark, sf).collect()) == whole


def test_verbatim_passages_of_the_tables(spark, sf):
    items = {r["item_id"]: d.folded(pa.array([r["text"]]))[0].tobytes() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    texts = {r["doc_id"]: d.folded(pa.array([r["text"]]))[0].tobytes() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    expected = {(k, i) for k, t in texts.items() for i, item in items.items() if item in t}
    got = {(r["doc_id"], i) for r in QUERIES["op2_benchmark_passages"](spark, sf).collect() for i in r["item_ids"]}
    assert expected == got and expected


def test_odd_rows(spark, odd_docs, no_docs, sf):
    text = odd_docs.where("doc_id = 4").first()["text"]
    benchmark = spark.createDataFrame([(7, text[:80]), (8, None), (None, text)], "item_id bigint, text string")
    rows = d.contamination(odd_docs, benchmark).collect()
    assert len(rows) == odd_docs.count()
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {4, 5, 6, 9, None}
    clean = d.clean_documents(odd_docs, benchmark)
    assert clean.columns == odd_docs.columns and {r["doc_id"] for r in clean.collect()} == {0, 1, 2, 3, 7, 8, 10, None}
    assert d.contamination(no_docs, benchmark).count() == 0
    assert d.contamination(odd_docs, benchmark.limit(0)).where("contaminated").count() == 0


def test_short_items_are_found_as_whole_words(spark, make_docs):
    items = ["Short Item", "ab", "x1", "What is\tlight?", "two words of 23 bytes..", "naïve", "光合作用", "  padded ", "...", " ", "ab"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    texts = ["a SHORT \n item.", "ashort item", "short items", "ab", "cab abc xab", "(x1)", "x12 0x1 _x1", "so: what is light? yes", "two words of 23 bytes..", "“NAÏVE”"]
    texts += ["naïvely", "什么是光合作用的意义", "unpadded padded", "wait...", "shor", "t item", "", "AB " * 3, "naïv", "z ab"]
    expected = [[0], [], [], [1, 10], [], [2], [], [3], [4], [5], [], [6], [7], [8], [], [], [], [1, 10], [], [1, 10]]
    got = {r["doc_id"]: (r["item_ids"], r["contaminated"]) for r in d.contamination(make_docs(texts), benchmark).collect()}
    assert got == {k: (e, bool(e)) for k, e in enumerate(expected)}


def test_short_items_agree_with_a_plain_search_across_pieces(monkeypatch):
    monkeypatch.setattr(d.words, "PIECE", 50)
    draw = random.Random(8)
    prose = lambda n: " ".join("".join(draw.choices("ab", k=draw.randrange(1, 4))) for _ in range(n))
    items = sorted({prose(draw.randrange(1, 7))[:23].strip() for _ in range(60)})
    texts = [prose(draw.randrange(0, 40)) for _ in range(60)]
    data, offsets = d.folded(pa.array(texts))
    expected = {(k, i) for k, t in enumerate(texts) for i, item in enumerate(items) if f" {item} " in f" {t} "}
    assert set(d.matches(data, offsets, d.Index.of(list(range(len(items))), items))) == expected and expected


def test_any_excerpt_of_71_bytes_is_found():
    draw = random.Random(9)
    item = "".join(draw.choices("abcdefghijklmnop", k=203))
    texts = [f"{'y' * 40}{item[s : s + 71]}{'z' * 40}" for s in range(203 - 71 + 1)]
    data, offsets = d.folded(pa.array(texts))
    assert [k for k, _ in d.matches(data, offsets, d.Index.of([0], [item]))] == list(range(len(texts)))


def test_ids_of_any_type_and_repeated_items(spark, make_docs):
    item = "A passage of the benchmark that is long enough to be cut into whole segments, whatever comes before and after it here."
    docs = make_docs(["before " + item + " after", "clean"])
    rows = [("mmlu-1", item), ("mmlu-1", item), ("mmlu-1", item.upper()), ("arc", item), (None, item), ("none", None)]
    got = d.contamination(docs, spark.createDataFrame(rows, "item_id string, text string")).orderBy("doc_id").collect()
    assert [(r["n_items"], r["item_ids"]) for r in got] == [(2, ["arc", "mmlu-1"]), (0, [])]
    numbers = spark.createDataFrame([(1, item), (1, item), (2, item)], "item_id int, text string")
    assert d.contamination(docs, numbers).orderBy("doc_id").first()["item_ids"] == [1, 2]
