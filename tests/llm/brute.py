"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def gram_set(text, n):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) >= n:
        return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def jaccard_components(rows, n, percent):
    """{id: (set size, smallest id reachable)} for rows of (id, text) with distinct ids."""
    sets = {i: gram_set(t, n) for i, t in rows}
    having = defaultdict(list)
    for i, s in sets.items():
        for gram in s:
            having[gram].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in sets.items():
        for j, shared in Counter(j for gram in s for j in having[gram] if j < i).items():
            if 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def without_repeats(rows, length):
    """{id: (bytes, removed, spans, sha256 of the rest)} for rows of (id, text)."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def edit_distance_inside(pattern, text):
    """The least number of edits between ``pattern`` and any part of ``text``."""
    row = [0] * (len(text) + 1)
    for k, p in enumerate(pattern, 1):
        new = [k]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeated_lines, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            repeated_lines += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count = Counter(windows)
    covered = {p for k, w in enumerate(windows) if count[w] > 1 for p in range(k, k + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": repeated_lines, "n_repeat_words": len(covered), "n_lines": lines,
        "n_upper": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall("[A-Za-z]", text)),
        "n_echoes": sum(a == b for a, b in zip(words, words[1:])),
    }
