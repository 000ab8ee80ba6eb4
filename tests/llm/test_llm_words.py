import numpy as np
import pyarrow as pa
from brute import WORD, gram_set
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import words
from recordloom.llm.anchors import anchors, window_hashes
from recordloom.llm.suffix_repeats import maximal_repeats

TEXT = st.text(alphabet="aAbB \n\té\x00日.", max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 60))
def test_words_and_grams(texts, size):
    seen = 0
    for part in words.slices(pa.array(texts, pa.string()), size):
        found = words.words(part, lower=True)
        value, first = words.gram_sets(found, 3)
        for k in range(len(part)):
            text = texts[part.first + k]
            assert found.counts[k] == len(WORD.findall(text or ""))
            assert first[k + 1] - first[k] == len(gram_set(text, 3))
        seen += len(part)
    assert seen == len(texts)


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    data = np.frombuffer(b"some words and averyveryverylongwordthatspanspieces end " * 9, np.uint8)
    texts = words.Texts(0, data, np.array([0, len(data)]))
    whole = words.words(texts).hashes
    monkeypatch.setattr(words, "PIECE", 64)
    assert (words.words(texts).hashes == whole).all()
    assert len(np.unique(whole)) == 5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=80), min_size=1, max_size=4))
def test_every_window_has_one_anchor_chosen_by_its_bytes(parts):
    parts = [bytes(b % 3 for b in p) for p in parts]
    data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0] + [len(p) for p in parts])
    found = anchors(data, offsets, 10, 4)
    by_window = {}
    covered = []
    for at, low, high in zip(found.at, found.low, found.high):
        for s in range(low, high + 1):
            covered.append(s)
            window = data[s : s + 10].tobytes()
            assert by_window.setdefault(window, at - s) == at - s and 0 <= at - s <= 6
    wanted = [s for a, b in zip(offsets[:-1], offsets[1:]) for s in range(a, b - 9)]
    assert sorted(covered) == wanted
    assert len(window_hashes(data, 10)) == max(0, len(data) - 9)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=14), min_size=1, max_size=5), st.integers(1, 4))
def test_maximal_repeats(parts, least):
    parts = [bytes(b % 2 for b in p) for p in parts]
    data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0] + [len(p) for p in parts])
    got = {}
    for length, at in maximal_repeats(data, offsets, least, 64):
        got[frozenset(at.tolist())] = length
    places = {}
    for k, part in enumerate(parts):
        for i in range(len(part)):
            for j in range(i + least, len(part) + 1):
                places.setdefault(part[i:j], []).append(int(offsets[k]) + i)
    edges = set(offsets.tolist())
    expected = {}
    for string, at in places.items():
        before = {-1 - p if p in edges else data[p - 1] for p in at}
        after = {-1 - p if p + len(string) in edges else data[p + len(string)] for p in at}
        if len(at) > 1 and len(before) > 1 and len(after) > 1:
            expected[frozenset(at)] = len(string)
    assert got == expected
