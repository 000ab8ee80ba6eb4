import hashlib
import itertools
import random
import re

import pytest

from recordloom.llm import conversation_repair as cr
from recordloom.llm import queries

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """Faults, cheapest edits and hash of one conversation, by trying all edits with a search over prefixes."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, kinds = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # (roles so far as a state, rows used) -> best (cost, audit, messages)
    best = {(0, 0): (0, "", ())}
    for used in range(len(rows) + 1):
        for _ in range(3):
            for (state, n), (cost, audit, out) in list(best.items()):
                if n == used:
                    to, role = cr.NEXT[state]
                    new = (cost + 2, audit + "I", (*out, (role, "")))
                    if (to, n) not in best or new[:2] < best[to, n][:2]:
                        best[to, n] = new
        if used == len(rows):
            break
        _, role, text = rows[used]
        for (state, n), (cost, audit, out) in list(best.items()):
            if n != used:
                continue
            moves = [(state, 3, "D", None)]
            if kinds[used] in ("", "truncated"):
                late = kinds[used] == "truncated"
                to, name = cr.NEXT[state]
                moves.append((to, 2 + late, "R", (name, text)))
                if role[:1] == "s" and state == 0:
                    moves.append((1, late, "K", (role, text)))
                if role[:1] == name[:1]:
                    moves.append((to, late, "K", (role, text)))
            for to, extra, letter, message in moves:
                new = (cost + extra, audit + letter, out if message is None else (*out, message))
                if (to, n + 1) not in best or new[:2] < best[to, n + 1][:2]:
                    best[to, n + 1] = new
    cost, audit, out = min(best[s, len(rows)] for s in (0, 3) if (s, len(rows)) in best)
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def check(spark, rows):
    summary, messages = cr.repair(spark.createDataFrame(rows, TURNS))
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in cr.digests(messages).collect()}
    got = {r["conv_id"]: (*r[1:], hashes.get(r["conv_id"], hashlib.sha256(b"").hexdigest())) for r in summary.collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = plain([r[1:] for r in rows if r[0] == conv])
    assert got == want
    return messages


def random_rows(draw, convs, most):
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "ux", "tool"]
    texts = ["Yes.", "No", "", " \t", None, "Why?", "a\nb!", "x " * 30, "Ünï."]
    for conv in convs:
        for k in range(draw.randrange(most)):
            yield (conv, draw.choice([k, k, k, k - 1, None]), draw.choice(roles), draw.choice(texts) if draw.random() < 0.5 else f"t{k}{draw.choice('.!a')}")


def test_against_plain_search(spark):
    draw = random.Random(5)
    check(spark, list(random_rows(draw, [*range(80), None], 9)))


@pytest.mark.parametrize("limits", [(3, 1 << 20, 2), (1, 1 << 20, 2), (256, 10, 3)])
def test_conversations_over_many_chunks(spark, monkeypatch, limits):
    draw = random.Random(6)
    for name, value in zip(("CHUNK_ROWS", "CHUNK_BYTES", "FAN"), limits):
        monkeypatch.setattr(cr, name, value)
    messages = check(spark, list(random_rows(draw, [1, 2, None], 60)))
    roles = {}
    for m in sorted(messages.collect(), key=lambda m: (m["conv_id"] or -1, m["place"])):
        roles.setdefault(m["conv_id"], []).append(m)
    for conv in roles.values():
        assert [m["place"] for m in conv] == list(range(len(conv)))
        assert re.fullmatch("s?(ua)+", "".join(m["role"][0] for m in conv))


def test_any_split_gives_the_same_cells():
    draw = random.Random(7)
    for _ in range(40):
        parts = [cr.row_cells(draw.choice(["user", "assistant", "system", ""]), draw.choice([1, 1, 2, 5]), draw.random() < 0.2, draw.random() < 0.3) for _ in range(7)]
        chart = {(k, k + 1): {pq: c[:2] for pq, c in part.items()} for k, part in enumerate(parts)}
        for length in range(2, 8):
            for first in range(8 - length):
                own = {}
                for split in range(first + 1, first + length):
                    x, y = ({pq: (*c, ()) for pq, c in chart[ab].items()} for ab in ((first, split), (split, first + length)))
                    for pq, cell in cr.combined(x, y).items():
                        own[pq] = min(own.get(pq, cell[:2]), cell[:2])
                chart[first, first + length] = own
        assert {pq: c[:2] for pq, c in cr.spans(parts).items()} == chart[0, 7]


def test_many_equal_rows_and_long_texts(spark):
    rows = [(1, 0, "user", "Same.")] * 700 + [(1, 1, "assistant", "long " * 100_000 + ".")] + [(2, None, None, None)] * 3
    check(spark, rows)


def test_power_of_equal_turns():
    for n in (0, 1, 2, 3, 8, 13):
        want = cr.spans([cr.CLOSURE, *[cr.turn_cells("u", False, True)] * n])
        got = cr.repeated(cr.turn_cells("u", False, True), n)
        assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}


def test_other_columns_and_empty_tables(spark):
    rows = [("a", 1, "user", "Hi."), (None, 2, "assistant", "Yo.")]
    df = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")
    for name in ("n", "digest", "blank", "known", "part", "seq", "idx", "cost", "audit", "place", "__conv", "up"):
        df = df.withColumn(name, df["turn"])
    summary, messages = cr.repair(df)
    assert sorted((r["conv_id"] or "", r["audit"]) for r in summary.collect()) == [("", "IK"), ("a", "KI")]
    assert messages.count() == 4
    summary, messages = cr.repair(df.limit(0))
    assert summary.count() == messages.count() == cr.digests(messages).count() == 0


def test_cheapest_for_all_short_role_sequences():
    for n in range(5):
        for roles in itertools.product(["user", "assistant", "system"], repeat=n):
            cells = cr.spans([cr.row_cells(r, 1, False, False) for r in roles])
            got = min(cells[0, q][:2] for q in (0, 3) if (0, q) in cells)
            assert got == plain([(k, r, f"{k}.") for k, r in enumerate(roles)])[5:7]


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(6) for t in range(40)]
    out = queries.damaged(spark.createDataFrame(rows, TURNS)).collect()
    import zlib

    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else "One Two" if kind == 2 else text
            want += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert sorted(map(tuple, out)) == sorted(want)
