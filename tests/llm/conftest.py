import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def prose(draw, n, words=400):
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


@pytest.fixture
def odd_docs(spark):
    draw = random.Random(3)
    long = prose(draw, 60_000, 5_000)
    base = prose(draw, 80)
    texts = [None, "", "   \n\t ", "x", base, base, base + " more", long, long[:-7] + "changed", "Ünï çödé\n\n" + base.upper(), "a " * 500]
    rows = [(k, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, base, None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("key", "size", "fp", "text_hash", "range", "row", "id", "x", "bits", "failed", "taken", "slot", "kind"):
        df = df.withColumn(name, df["n_chars"])
    return df


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def make_docs(spark):
    def make(texts, sources=None):
        rows = [(k, t, "en", sources[k] if sources else "s", len(t or "")) for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def sf(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver tables are not mounted")
    return SF
