"""Tool calls and their results as training messages: linked, ordered, validated, and written as canonical JSON.

Calls and results meet by a hash join on conversation and identifier, after each side has been reduced to one row an
identifier, so a repeated identifier multiplies nothing. A call may refer to earlier results in its arguments as
``{"$ref": "<id>"}``; calls are ordered by rounds over these references, each round settling the calls whose references
are settled. Every message is a row with its place in the order; a conversation is never gathered in one task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.tables import by_batches, written

_TYPES: dict[str, tuple[type, ...]] = {"object": (dict,), "array": (list,), "string": (str,), "boolean": (bool,), "null": (type(None),), "integer": (int,), "number": (int, float)}


def canonical(value: Any) -> str:
    """JSON with sorted keys and no blanks; whole floats are written as whole numbers, and there is no NaN."""

    def plain(x: Any) -> Any:
        if isinstance(x, float) and x.is_integer() and abs(x) < 1 << 53:
            return int(x)
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def references(value: Any) -> list[str]:
    """Identifiers that arguments refer to, sorted."""
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return [value["$ref"]]
        value = list(value.values())
    return sorted({r for v in value for r in references(v)}) if isinstance(value, list) else []


def violations(value: Any, schema: dict, place: str = "$") -> list[str]:
    """What of ``value`` does not fit the schema: types, enumerations, bounds, lengths, properties and items.

    A reference fits everywhere, as its value is not known yet.
    """
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []
    out = []
    kinds = schema.get("type", list(_TYPES))
    kinds = [kinds] if isinstance(kinds, str) else kinds
    whole = isinstance(value, float) and value.is_integer()
    if not any(isinstance(value, _TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number")) or k == "integer" and whole for k in kinds):
        return [f"{place}: not {' or '.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{place}: not one of the values")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{place}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{place}: above maximum")
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        if len(value) < schema.get(low, 0):
            out.append(f"{place}: too short")
        if len(value) > schema.get(high, len(value)):
            out.append(f"{place}: too long")
    if isinstance(value, list) and "items" in schema:
        for k, item in enumerate(value):
            out += violations(item, schema["items"], f"{place}[{k}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{place}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{place}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{place}.{k}: not known")
    return out


def _call_message(call_id: str | None, name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[str, list[str], list[str]]:
    """(message, references, errors) of a call; unreadable arguments are kept as they are, as text."""
    errors, refs, text = [], [], arguments or ""
    try:
        value = json.loads(arguments or "", parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))
        written_out = canonical(value)
        written_out.encode()  # an escaped half of a surrogate pair is no text
        text, refs = written_out, references(value)
        if name not in schemas:
            errors.append("unknown tool")
        else:
            errors += violations(value, schemas[name])
    except UnicodeEncodeError:
        errors.append("arguments are not text")
    except (ValueError, RecursionError):
        errors.append("arguments are not JSON")
    function = {"name": name, "arguments": text}
    return canonical({"role": "assistant", "tool_calls": [{"id": call_id, "type": "function", "function": function}]}), refs, errors


def read_calls(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """(conv_id, turn, call_id, message, refs, errors) of ``calls`` (conv_id, turn, call_id, name, arguments)."""
    rows = calls.select("conv_id", "turn", "call_id", "name", "arguments")
    conv = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_call_message(*row, schemas) for row in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
            message, refs, errors = (list(x) for x in zip(*found)) if found else ([], [], [])
            lists = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(message, pa.string()), pa.array(refs, lists), pa.array(errors, lists)],
                ["conv_id", "turn", "call_id", "message", "refs", "errors"],
            )

    typed = rows.withColumn("turn", F.col("turn").cast("long")).withColumns({c: F.col(c).cast("string") for c in ("call_id", "name", "arguments")})
    return by_batches(typed, run, f"conv_id {conv}, turn long, call_id string, message string, refs array<string>, errors array<string>")


def _key(call_id: str = "call_id") -> Column:
    """Conversation and identifier as a pair, in which a null conversation is a value; null where there is no identifier."""
    return F.when(F.col(call_id).isNotNull(), F.struct(F.col("conv_id").alias("conv"), F.col(call_id).alias("call")))


def settled(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, level, at, done_at): the rank of each call among its references, and the turns it and its result are put at.

    Calls in a cycle of references, or behind one, are not in the result. One round for each level.
    """
    needs = edges.groupBy("key").agg(F.count(F.lit(1)).alias("needed"))
    all_calls = written(calls.join(needs, "key", "left"), "calls")
    done = all_calls.where(F.col("needed").isNull()).select("key", F.lit(0).alias("level"), F.col("turn").alias("at"), F.greatest("turn", "result_turn").alias("done_at"))
    done = written(done, "settled")
    waiting = all_calls.where(F.col("needed").isNotNull())
    fresh, level, parts = done, 0, [done]
    counts = None
    while True:
        level += 1
        reached = edges.join(fresh.select(F.col("key").alias("ref"), "done_at"), "ref").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("done_at").alias("after"))
        if counts is not None:
            reached = reached.unionByName(counts).groupBy("key").agg(F.sum("n").alias("n"), F.max("after").alias("after"))
        counts = written(reached, "reached")
        now = counts.join(waiting, "key").where("n = needed")
        at = F.greatest("turn", "after")
        fresh = written(now.select("key", F.lit(level).alias("level"), at.alias("at"), F.greatest(at, "result_turn").alias("done_at")), "settled")
        if fresh.isEmpty():
            break
        parts.append(fresh)
        counts = counts.join(fresh.select("key"), "key", "left_anti")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], others: DataFrame | None = None) -> DataFrame:
    """Messages as rows: conv_id, place (``at``, ``level``, ``kind``, ``turn``, ``call_id``), ``linked``, ``valid``, ``errors``, ``message``.

    ``results`` has conv_id, turn, call_id, content; ``others`` (conv_id, turn, role, content) are plain messages. Sorted
    by place, a result follows its call, and a call the results it refers to. Of several calls, or results, with an
    identifier in a conversation the first one (by turn, then content) is linked; the others are kept as errors. Calls
    without a result, results without a call, null identifiers, unknown references and cycles are errors too; calls in
    or behind a cycle keep their turn and have a null level. Null conversations count as one. A null content is an
    empty text. Empty tables give no rows.
    """
    read = written(read_calls(calls, schemas).withColumn("key", _key()), "read-calls")
    first_call = read.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("turn", "message")).alias("call"))
    content = F.coalesce(F.col("content").cast("string"), F.lit(""))
    answer = results.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("call_id").cast("string").alias("call_id"), content.alias("content")).withColumn("key", _key())
    first_result = answer.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("turn", "content")).alias("result"))
    nodes = first_call.join(first_result, "key", "left").select("key", F.col("call.turn").alias("turn"), F.coalesce("result.turn", "call.turn").alias("result_turn"))
    refs = read.join(first_call, "key").where(F.struct("turn", "message") == F.col("call")).select("key", "conv_id", F.explode("refs").alias("ref_id")).distinct()
    refs = refs.select("key", _key("ref_id").alias("ref"))
    edges = written(refs.join(first_call.select(F.col("key").alias("ref")), "ref").select("key", "ref"), "references")
    unknown = refs.join(edges, ["key", "ref"], "left_anti").select("key").distinct().withColumn("unknown", F.lit(True))
    order = settled(nodes, edges)
    error = lambda condition, text: F.when(condition, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    linked_call = read.join(first_call, "key", "left").join(first_result, "key", "left").join(order, "key", "left").join(unknown, "key", "left")
    is_first = F.coalesce(F.struct("turn", "message") == F.col("call"), F.lit(False))
    call_rows = linked_call.select(
        "conv_id", F.coalesce(F.when(is_first, F.col("at")), F.col("turn")).alias("at"), F.when(is_first, F.col("level")).alias("level"), F.lit(1).alias("kind"), "turn", "call_id",
        (is_first & F.col("result").isNotNull()).alias("linked"),
        F.concat(
            "errors", error(F.col("key").isNull(), "no identifier"), error(F.col("key").isNotNull() & ~is_first, "repeated identifier"), error(is_first & F.col("result").isNull(), "no result"),
            error(is_first & F.coalesce("unknown", F.lit(False)), "unknown reference"), error(is_first & F.col("level").isNull(), "cycle"),
        ).alias("errors"),
        "message",
    )
    linked_result = answer.join(first_result, "key", "left").join(first_call, "key", "left").join(order, "key", "left")
    chosen = F.coalesce(F.struct("turn", "content") == F.col("result"), F.lit(False))
    result_rows = linked_result.select(
        "conv_id", F.coalesce(F.when(chosen, F.col("done_at")), F.col("turn")).alias("at"), F.when(chosen, F.col("level")).alias("level"), F.lit(2).alias("kind"), "turn", "call_id",
        (chosen & F.col("call").isNotNull()).alias("linked"),
        F.concat(error(F.col("key").isNull(), "no identifier"), error(F.col("key").isNotNull() & ~chosen, "repeated identifier"), error(F.col("key").isNotNull() & F.col("call").isNull(), "no call")).alias("errors"),
        F.struct("call_id", "content").alias("body"),
    )
    plain = _messages(result_rows.withColumn("role", F.lit("tool")))
    if others is not None:
        own = others.select(
            "conv_id", F.col("turn").cast("long").alias("at"), F.lit(0).alias("level"), F.lit(0).alias("kind"), F.col("turn").cast("long").alias("turn"), F.lit(None).cast("string").alias("call_id"),
            F.lit(False).alias("linked"), F.array().cast("array<string>").alias("errors"), F.struct(F.lit(None).cast("string").alias("call_id"), content.alias("content")).alias("body"), F.col("role").cast("string").alias("role"),
        )
        plain = plain.unionByName(_messages(own))
    return call_rows.unionByName(plain).withColumn("valid", F.size("errors") == 0)


def _messages(rows: DataFrame) -> DataFrame:
    """``body`` and ``role`` as the canonical JSON of a plain message or a tool's result."""
    kept = [f for f in rows.schema if f.name not in ("body", "role")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = []
            for body, role in zip(batch.column("body").to_pylist(), batch.column("role").to_pylist()):
                message = {"role": role, "content": body["content"]}
                text.append(canonical(message | ({"tool_call_id": body["call_id"]} if role == "tool" else {})))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(text, pa.string())], [*[f.name for f in kept], "message"])

    return by_batches(rows, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", message string")
