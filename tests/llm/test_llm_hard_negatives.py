import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def whole(x):
    return math.floor(256 * x) if abs(x) < 2.0**45 else int(x) * 256


def plain(rows, every, positives=5, negatives=10):
    usable = [(i, [whole(x) for x in v], lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b))))
    out = []
    anchors = {(i, tuple(v), lab) for i, v, lab in usable if i % every == 0}
    for anchor, vector, label in sorted(anchors):
        scored = sorted((-score(vector, v), i, lab) for i, v, lab in usable)
        for minus, positive, _ in [s for s in scored if s[2] == label and s[1] != anchor][:positives]:
            fitting = [s for s in scored if s[2] != label and 30 * -minus <= 100 * -s[0] <= 90 * -minus][:negatives]
            out += [(anchor, positive, rank, i, -minus, -s) for rank, (s, i, _) in enumerate(fitting, 1)]
    return sorted(out)


def mined(spark, rows, every, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("parts", "own", "score", "rank", "anchor", "slot", "block", "n"):
        df = df.withColumn(name, df["label"])
    return sorted(map(tuple, hn.mine(hn.usable_rows(df), F.col("vec_id") % every == 0, **more).collect()))


def vectors(draw, n, dims, scale=0.3):
    return [(k, [draw.gauss(0.1, scale) for _ in range(dims)], draw.randrange(4)) for k in range(n)]


@pytest.mark.parametrize("scale,dims", [(0.3, 16), (3.0, 5), (400.0, 7), (1e12, 4), (1e5, 3)])
def test_against_plain_python(spark, scale, dims):
    draw = random.Random(dims)
    rows = vectors(draw, 150, dims, scale)
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_odd_rows(spark):
    draw = random.Random(2)
    rows = vectors(draw, 60, 6)
    rows += [(None, rows[0][1], 1), (70, None, 1), (71, [None, 1.0], 1), (72, [float("nan")], 1), (73, [float("inf")], 2), (74, rows[3][1], None), (80, [], 1), (90, [0.5], 2), (91, [0.5, -0.5] * 6, 3)]
    rows += [(k, rows[5][1], k % 3) for k in range(100, 130)]  # many ties
    rows += rows[:20]  # repeated rows
    rows += [(10, rows[11][1], 2)]  # an id with two vectors
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_blocks_and_tiles_change_nothing(spark, monkeypatch):
    rows = vectors(random.Random(3), 120, 8)
    for name, value in (("BLOCK_BYTES", 8 * 8 * 3), ("TILE", 50), ("CANDIDATES", 17)):
        monkeypatch.setattr(hn, name, value)
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_nothing_to_mine(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(1, [0.5], 1)], 10) == []
    assert mined(spark, [(0, [0.5], 1)], 10) == []
    assert mined(spark, [(0, [0.5], 1), (1, [0.5], 1), (2, [0.1], 2)], 10) == plain([(0, [0.5], 1), (1, [0.5], 1), (2, [0.1], 2)], 10)


@pytest.mark.parametrize("low,high,dims", [(-3, 5, 4), (0, 0, 1), (-300, 300, 64), (-(10**9), 10**9, 10), (-(10**40), 5, 3)])
def test_packing_is_exact(low, high, dims):
    draw = random.Random(high)
    packing = hn.Packing(min(0, low), max(0, high), dims)
    rows = [[draw.randint(low, high) for _ in range(dims)] for _ in range(23)] + [[low] * dims, [high] * dims]
    if packing.exact:
        matrix = np.array(rows, object)
    else:
        matrix = packing.matrix(rows)
    want = [[max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b)))) for b in rows] for a in rows]
    assert packing.scores(matrix, matrix).tolist() == want
    assert packing.fields >= 1 and (high - low > 10**6 or packing.fields >= 2)


def test_bad_components_are_left_out(spark):
    df = spark.createDataFrame([(1, [1e308 * 1.5], 1), (2, [0.0039], 1), (3, [-0.0001], 1)], SCHEMA)
    assert {r["vec_id"]: list(r["parts"]) for r in hn.usable_rows(df).collect()} == {2: [0.0], 3: [-1.0]}
