"""Repair of conversations by weighted interval parsing in the manner of CYK, over spans of turns.

A repaired conversation's roles read ``(s?(ua)+)?``. The repair grammar in Chomsky normal form has a non-terminal for
each pair of states of that language, "a span whose repair leads from p to q": it is either one turn with one edit, or two
spans that meet in a state r. A cell holds the cheapest repair of a span as (cost, audit), the audit being the edits'
initials; of equal costs the least audit counts. Insertions stand before and after any turn: every cell is closed under
them.

No audit of a span is the beginning of another one of the same cost, since what it has more could be insertions only, and
these cost. So the least audit of a span is made of the least audits of its parts, and as the grammar has a
non-terminal for every pair of states, a span has the same cells wherever it is split. Spans are therefore combined
bottom-up by length, each from its two halves, which takes linear time instead of the cube of the number of turns.

Nothing gathers a conversation: turns are dealt in order by range, each task parses them in chunks of bounded size, and
the chunks' cells are combined in rounds of bounded fan-in. The chosen states then go back down to the chunks, which are
repaired each for itself.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.tables import by_batches, by_runs, written

#: Turns, and bytes of text, of a chunk; a turn with more bytes is one for itself.
CHUNK_ROWS, CHUNK_BYTES = 256, 1 << 20
#: Chunks, or groups of them, combined at once.
FAN = 64
#: States of a repaired conversation: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
N = 4
#: Where an added or renamed turn leads, and its role.
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
_KEPT = {"s": [(START, SYSTEM)], "u": [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)]}
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"
_INSERT, _RENAME, _DELETE, _TRUNCATED = 2, 2, 3, 1

#: (p, q) -> (cost, audit, states between the parts)
Cells = dict[tuple[int, int], tuple[int, str, tuple[int, ...]]]


def combined(x: Cells, y: Cells) -> Cells:
    """Cells of a span from those of its two parts."""
    out: Cells = {}
    for (p, r), (c1, a1, s1) in x.items():
        for (r2, q), (c2, a2, s2) in y.items():
            if r == r2:
                cost, best = c1 + c2, out.get((p, q))
                if best is None or cost < best[0] or (cost == best[0] and a1 + a2 < best[1]):
                    out[p, q] = (cost, a1 + a2, (*s1, r, *s2))
    return out


def spans(parts: list[Cells]) -> Cells:
    """Cells of the span of all ``parts``, by halves."""
    if not parts:
        return CLOSURE
    while len(parts) > 1:
        parts = [combined(parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def _bare(cells: Cells) -> Cells:
    return {pq: (cost, audit, ()) for pq, (cost, audit, _) in cells.items()}


def _closure() -> Cells:
    """Insertions alone: at most one of each role is worth having between two states."""
    step: Cells = {(p, p): (0, "", ()) for p in range(N)}
    step |= {(p, q): (_INSERT, "I", ()) for p, (q, _) in NEXT.items()}
    return _bare(combined(step, step))


CLOSURE = _closure()


@functools.lru_cache(maxsize=4096)
def turn_cells(initial: str, forced: bool, truncated: bool) -> Cells:
    """Cells of one turn: kept, renamed or deleted, which a ``forced`` one has to be, between any insertions."""
    late = _TRUNCATED if truncated else 0
    cells: Cells = {(p, p): (_DELETE, "D", ()) for p in range(N)}
    if not forced:
        for edges, cost, letter in (((p, q) for p, (q, _) in NEXT.items()), _RENAME + late, "R"), (_KEPT.get(initial, ()), late, "K"):
            for pq in edges:
                if pq not in cells or (cost, letter) < cells[pq][:2]:
                    cells[pq] = (cost, letter, ())
    return _bare(combined(combined(CLOSURE, cells), CLOSURE))


def repeated(cells: Cells, n: int) -> Cells:
    """Cells of ``n`` equal turns in a row, by doubling."""
    out, power = CLOSURE, cells
    while n:
        if n & 1:
            out = _bare(combined(out, power))
        power, n = (_bare(combined(power, power)), n >> 1) if n > 1 else (power, 0)
    return out


def row_cells(role: str, n: int, forced: bool, truncated: bool) -> Cells:
    """Cells of ``n`` equal turns, the later of which repeat the first."""
    first = turn_cells(role[:1], forced, truncated and not forced)
    return first if n == 1 else _bare(combined(first, repeated(turn_cells("", True, False), n - 1)))


def _flat(cells: Cells) -> tuple[list, list, list]:
    own = [cells.get((p, q)) for p in range(N) for q in range(N)]
    return [c and c[0] for c in own], [c and c[1] for c in own], [c and list(c[2]) for c in own]


def _unflat(costs: list, audits: list) -> Cells:
    return {divmod(k, N): (cost, audit, ()) for k, (cost, audit) in enumerate(zip(costs, audits)) if cost is not None}


def _illegal(before: str | None, after: str) -> int:
    return int(before is not None and before + after not in _LEGAL)


def faults(turns: DataFrame) -> DataFrame:
    """Distinct rows of ``turns`` (conv_id, turn, role, text; no null role or text) with their number and faults.

    ``n`` is the number of equal rows, ``blank`` says that the text has no character but white space, ``known`` that an
    earlier turn of the conversation has the same role and text, ``truncated`` that the last character is no ``.``, ``!``
    or ``?``. Earlier is by turn, unknown ones first.
    """
    once = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("digest", F.sha2("text", 256))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = once.groupBy(F.col("conv_id").alias("__conv"), F.col("role").alias("__role"), F.col("digest").alias("__digest")).agg(F.min(place).alias("__first"))
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (F.col("digest") == F.col("__digest"))
    end = F.rtrim(F.col("text"), F.lit(_SPACE))
    return once.join(first, same).select(
        "conv_id", "turn", "role", "text", "digest", "n", (end == "").alias("blank"),
        (~F.col("turn").eqNullSafe(F.col("__first.turn"))).alias("known"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )


def chunks(rows: DataFrame) -> DataFrame:
    """``faults`` in order, cut into chunks of a conversation: place (``part``, ``seq``), cells, outer roles, and the turns themselves."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {conv}, part int, seq int, costs array<bigint>, audits array<string>, first string, last string, illegal bigint, "
        "turns array<struct<turn: bigint, role: string, text: string, n: bigint>>"
    )
    names = ["conv_id", "part", "seq", "costs", "audits", "first", "last", "illegal", "turns"]
    order = ["conv_id", "turn", "role", "digest"]
    dealt = rows.withColumn("forced", F.col("blank") | F.col("known")).repartitionByRange(*order).sortWithinPartitions(*order).drop("digest", "blank", "known")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[dict] = []
        size = seq = 0
        kind: pa.DataType | None = None

        def chunk() -> pa.RecordBatch:
            cells = spans([row_cells(r["role"], r["n"], r["forced"], r["truncated"]) for r in held])
            costs, audits, _ = _flat(cells)
            initials = [r["role"][:1] for r in held]
            illegal = sum(r["n"] - 1 for r in held) + sum(_illegal(a, b) for a, b in zip(initials, initials[1:]))
            turns = [{k: r[k] for k in ("turn", "role", "text", "n")} for r in held]
            values = [held[0]["conv_id"], part, seq, costs, audits, initials[0], initials[-1], illegal, turns]
            kinds = [kind, pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), None]
            return pa.RecordBatch.from_arrays([pa.array([v], k or _TURNS) for v, k in zip(values, kinds)], names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if held and (row["conv_id"] != held[0]["conv_id"] or len(held) >= CHUNK_ROWS or size + len(row["text"]) > CHUNK_BYTES):
                    yield chunk()
                    held, size, seq = [], 0, seq + 1
                held.append(row)
                size += len(row["text"])
        if held:
            yield chunk()

    return by_batches(dealt, run, schema)


_TURNS = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64())]))
_NODE = "idx bigint, costs array<bigint>, audits array<string>, first string, last string, illegal bigint, paths array<array<int>>"


def _joined(nodes: DataFrame) -> DataFrame:
    """One level up: ``FAN`` neighbours at a time as one node, with the states between them for each of its cells."""
    conv = nodes.schema["conv_id"].dataType.simpleString()

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = table.to_pylist()
        groups: dict = {}
        for row in rows:
            groups.setdefault((row["conv_id"], row["up"]), []).append(row)
        out = []
        for (own, up), parts in groups.items():
            parts.sort(key=lambda r: r["idx"])
            costs, audits, paths = _flat(spans([_unflat(r["costs"], r["audits"]) for r in parts]))
            illegal = sum(r["illegal"] for r in parts) + sum(_illegal(a["last"], b["first"]) for a, b in zip(parts, parts[1:]))
            out.append((own, up, costs, audits, parts[0]["first"], parts[-1]["last"], illegal, paths))
        kinds = [table.schema.field("conv_id").type, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.list_(pa.list_(pa.int32()))]
        names = ["conv_id", "idx", "costs", "audits", "first", "last", "illegal", "paths"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return by_runs(nodes.withColumn("up", F.floor(F.col("idx") / FAN)).drop("paths"), ["conv_id", "up"], run, f"conv_id {conv}, {_NODE}", rows=2_000)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def parsed(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``chunks``: (conv_id, cost, audit, illegal) of each conversation, and (conv_id, part, seq, p, q, place), the states each chunk is repaired between and the turns before it."""
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("part", "seq")) - 1
    keys = pieces.select("conv_id", "part", "seq").withColumn("idx", number.cast("long"))
    cells = pieces.drop("turns")
    k = keys.select(F.col("conv_id").alias("__conv"), F.col("part").alias("__part"), F.col("seq").alias("__seq"), "idx")
    placed = cells.join(k, _same("conv_id", "__conv") & (F.col("part") == F.col("__part")) & (F.col("seq") == F.col("__seq"))).drop("__conv", "__part", "__seq")
    leaves = written(placed.withColumn("paths", F.lit(None).cast("array<array<int>>")), "cells")
    levels = [leaves.drop("part", "seq")]
    while levels[-1].where("idx > 0").head(1):
        levels.append(written(_joined(levels[-1]), "cells"))
    at = lambda q: F.struct(F.element_at("costs", q + 1).alias("cost"), F.element_at("audits", q + 1).alias("audit"), F.lit(q).alias("q"))
    ended = F.array_min(F.filter(F.array(at(START), at(ASSISTANT)), lambda c: c["cost"].isNotNull()))
    top = levels[-1].withColumn("best", ended)
    whole = top.select("conv_id", "best.cost", "best.audit", "illegal")
    chosen = top.select("conv_id", "idx", F.lit(START).alias("p"), F.col("best.q").alias("q"), "paths")
    for level in levels[-2::-1]:
        between = F.concat(F.array("p"), F.element_at("paths", F.col("p") * N + F.col("q") + 1), F.array("q"))
        above = chosen.select(F.col("conv_id").alias("__conv"), F.col("idx").alias("__up"), between.alias("__between"))
        down = level.join(above, _same("conv_id", "__conv") & (F.floor(F.col("idx") / FAN) == F.col("__up")))
        own = (F.col("idx") % FAN).cast("int")
        chosen = down.select("conv_id", "idx", F.element_at("__between", own + 1).alias("p"), F.element_at("__between", own + 2).alias("q"), "paths")
    states = chosen.select(F.col("conv_id").alias("__conv"), F.col("idx").alias("__idx"), "p", "q")
    audit = F.element_at("audits", F.col("p") * N + F.col("q") + 1)
    held = leaves.join(states, _same("conv_id", "__conv") & (F.col("idx") == F.col("__idx"))).select("conv_id", "part", "seq", "idx", "p", "q", audit.alias("audit"))
    made = F.length(F.translate("audit", "D", ""))
    before = F.sum(made).over(Window.partitionBy("conv_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1))
    return whole, held.withColumn("place", F.coalesce(before, F.lit(0)).cast("long")).drop("idx")


def _repaired(pieces: DataFrame, held: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text) of the repaired turns, chunk by chunk."""
    conv = pieces.schema["conv_id"].dataType.simpleString()
    k = held.select(F.col("part").alias("__part"), F.col("seq").alias("__seq"), "p", "audit", "place")
    both = pieces.select("conv_id", "part", "seq", "turns").join(k, (F.col("part") == F.col("__part")) & (F.col("seq") == F.col("__seq"))).select("conv_id", "turns", "p", "audit", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                out = [(row["conv_id"], row["place"] + k, *turn) for k, turn in enumerate(_edited(row["turns"], row["p"], row["audit"]))]
                kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 6, kinds)], ["conv_id", "place", "edit", "turn", "role", "text"])

    return by_batches(both, run, f"conv_id {conv}, place bigint, edit string, turn bigint, role string, text string")


def _edited(turns: list[dict], state: int, audit: str) -> Iterator[tuple[str, int | None, str, str]]:
    letters = iter(audit)
    for turn in turns:
        left = turn["n"]
        while left:
            letter = next(letters)
            if letter != "I":
                left -= 1
            if letter == "D":
                continue
            if letter == "K":
                state, role = next(q for p, q in _KEPT[turn["role"][:1]] if p == state), turn["role"]
            else:
                state, role = NEXT[state]
            yield letter, None if letter == "I" else turn["turn"], role, "" if letter == "I" else turn["text"]
    for letter in letters:
        state, role = NEXT[state]
        yield letter, None, role, ""


def repair(turns: DataFrame, *, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: one row a conversation, and the repaired turns.

    The first has ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``; the
    second ``conv_id``, ``place`` (from 0, without gaps), ``edit`` (K, R or I), ``turn`` (null if inserted), ``role`` and
    ``text``; a conversation of which nothing is left has no row there. Turns are taken by number, unknown ones first, then
    by role, then by sha256 of the text; a null role or text is one space. A turn's first fault counts: blank,
    duplicate (role and text seen earlier), truncated. Blank and duplicate turns are deleted (3); others are kept
    (0), renamed to user or assistant (2) or deleted (3); empty turns are inserted (2); a truncated turn that stays costs 1
    more. A conversation without an identifier is one of its own. Repeated rows are duplicates. Other columns are not
    looked at; an empty table gives two empty ones.
    """
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = written(faults(turns.select(F.col(f"`{conv_column}`").alias("conv_id"), F.col(f"`{turn_column}`").cast("long").alias("turn"), space(role_column).alias("role"), space(text_column).alias("text"))), "turns")
    pieces = written(chunks(rows), "chunks")
    whole, held = parsed(pieces)
    # equal turns of a number are few rows by now, so numbers are told apart before they are counted
    by_turn = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.when(F.col("known"), 0).otherwise(1))).alias("duplicate"),
        F.sum((~F.col("blank") & ~F.col("known") & F.col("truncated")).cast("long")).alias("truncated"),
    )
    counts = by_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    w = whole.select(F.col("conv_id").alias("__conv"), "cost", "audit", "illegal")
    summary = counts.join(w, _same("conv_id", "__conv")).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return summary, _repaired(pieces, held)


def digests(messages: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the hash of each conversation's ``role:text``, joined by newlines.

    A hash runs over the bytes one after another, so a conversation goes through one task; it is streamed from a sort that spills, and
    no more than a batch of it is held.
    """
    conv = messages.schema["conv_id"].dataType.simpleString()
    lines = messages.select("conv_id", "place", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kind, hasher = None, None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([own], kind), pa.array([hasher.hexdigest()])], ["conv_id", "repaired_sha256"])
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if hasher is None or conv_id != own:
                    if hasher is not None:
                        yield row()
                    own, hasher = conv_id, hashlib.sha256(line)
                else:
                    hasher.update(b"\n" + line)
        if hasher is not None:
            yield row()

    return by_batches(lines.repartition("conv_id").sortWithinPartitions("conv_id", "place"), run, f"conv_id {conv}, repaired_sha256 string")
