import random

import public_tokenizers
import pytest

from recordloom.llm.token_counts import count_tokens

tokenizers = pytest.importorskip("tokenizers")
FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "s", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "é", "日", "1", "²", "!", "'", "<|endoftext|>", "\x1c", "\x85", "\xa0", "🙂", "_", "Ⅷ", "the", " of"]


def expected(texts):
    of = tokenizers.Tokenizer.from_file(FILE)
    return [len(e.ids) for e in of.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_the_library(make_docs):
    draw = random.Random(1)
    texts = ["".join(draw.choices(PIECES, k=draw.randrange(14))) for _ in range(1500)]
    texts += [None, "", "a" * 3000, " " * 2000, "<|endoftext|><|endoftext|>", "x <|endoftext|>", "I'LL can't", "word " * 3000]
    got = {r["doc_id"]: r for r in count_tokens(make_docs(texts).repartition(3), FILE).collect()}
    assert [got[k]["n_tokens"] for k in range(len(texts))] == expected(texts)
    assert [got[k]["n_bytes"] for k in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got.values())


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.select("text").collect()
    got = sorted(r["n_tokens"] for r in count_tokens(odd_docs, FILE).collect())
    assert got == sorted(expected([r["text"] for r in rows]))
    assert count_tokens(no_docs, FILE).collect() == []
