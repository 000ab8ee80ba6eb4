import json

from recordloom.llm import tool_calls as t
from recordloom.llm.queries import QUERIES

SCHEMAS = {"f": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {"x": {"type": ["integer", "string"], "minimum": 0}, "y": {"type": "array", "items": {"enum": [1, 2]}, "maxItems": 2}}}}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string"
RESULTS = "conv_id long, turn long, call_id string, content string"


def test_canonical_json():
    assert t.canonical({"b": 1.0, "a": [1.5, "é", None]}) == '{"a":[1.5,"é",null],"b":1}'
    assert t.references({"a": [{"$ref": "q"}, {"$ref": "p"}], "b": {"$ref": "q"}}) == ["p", "q"]


def test_validation():
    of = lambda value: t.violations(value, SCHEMAS["f"])
    assert of({"x": 1, "y": [1, 2]}) == [] and of({"x": {"$ref": "c"}}) == []
    assert of({"y": [3]}) == ["$.x: missing", "$.y[0]: not one of the values"]
    assert of({"x": -1, "z": 0}) == ["$.x: below minimum", "$.z: not known"]
    assert of([]) == ["$: not object"] and of({"x": True}) == ["$.x: not integer or string"]
    assert of({"x": 2.0}) == [] and of({"x": 2.5}) == ["$.x: not integer or string"]


def linked(spark, calls, results, others=None):
    rows = t.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS, others).collect()
    return sorted(rows, key=lambda r: (str(r["conv_id"]), r["at"] or 0, r["level"] is None, r["level"] or 0, r["kind"], r["call_id"] or ""))


def test_results_follow_their_calls_and_calls_the_results_they_refer_to(spark):
    calls = [
        (1, 1, "c", "f", '{"x": {"$ref": "b"}}'),
        (1, 2, "b", "f", '{"x": {"$ref": "a"}}'),
        (1, 3, "a", "f", '{"x": 1}'),
        (2, 1, "a", "f", '{"x": 2}'),
    ]
    results = [(1, 4, "b", "rb"), (1, 0, "a", "ra"), (1, 5, "c", "rc"), (2, 9, "a", None)]
    rows = linked(spark, calls, results)
    assert [(r["conv_id"], r["kind"], r["call_id"]) for r in rows] == [(1, 1, "a"), (1, 2, "a"), (1, 1, "b"), (1, 2, "b"), (1, 1, "c"), (1, 2, "c"), (2, 1, "a"), (2, 2, "a")]
    assert all(r["valid"] and r["linked"] for r in rows)
    assert json.loads(rows[1]["message"]) == {"role": "tool", "tool_call_id": "a", "content": "ra"}
    assert json.loads(rows[0]["message"])["tool_calls"][0]["function"] == {"name": "f", "arguments": '{"x":1}'}


def test_errors(spark):
    calls = [
        (1, 1, "a", "f", '{"x": {"$ref": "b"}}'), (1, 2, "b", "f", '{"x": {"$ref": "a"}}'), (1, 3, "c", "f", '{"x": {"$ref": "a"}}'),
        (1, 4, "d", "g", "{}"), (1, 5, "d", "f", '{"x": 1}'), (1, 6, None, "f", "not json"), (1, 7, "e", "f", '{"x": {"$ref": "zz"}}'),
        (None, 1, "n", "f", '{"x": 1}'), (None, 1, "n", "f", '{"x": 1}'), (1, None, "o", None, None),
    ]
    results = [(1, 4, "d", "1"), (1, 4, "d", "2"), (1, 8, "q", "?"), (1, 9, None, None)]
    rows = linked(spark, calls, results)
    assert len(rows) == len(calls) + len(results)
    errors = {}
    for r in rows:
        errors.setdefault((r["conv_id"], r["kind"], r["call_id"]), []).append(sorted(r["errors"]))
    assert errors[1, 1, "a"] == errors[1, 1, "b"] == errors[1, 1, "c"] == [["cycle", "no result"]]
    assert sorted(errors[1, 1, "d"]) == [["repeated identifier"], ["unknown tool"]]
    assert errors[1, 1, None] == [["arguments are not JSON", "no identifier"]]
    assert errors[1, 1, "e"] == [["no result", "unknown reference"]]
    assert sorted(errors[1, 2, "d"]) == [[], ["repeated identifier"]]
    assert errors[1, 2, "q"] == [["no call"]] and errors[1, 2, None] == [["no identifier"]]
    assert errors[None, 1, "n"] == [["no result"]] * 2  # repeated rows are the same call


def test_empty_and_long(spark):
    assert linked(spark, [], []) == []
    text = "é" * 300_000
    rows = linked(spark, [(1, 1, "a", "f", json.dumps({"x": text}))], [(1, 2, "a", text)], spark.createDataFrame([(1, 0, "system", None), (1, 3, None, "")], "conv_id long, turn long, role string, content string"))
    assert len(rows) == 4 and all(r["valid"] for r in rows) and len(rows[1]["message"]) > 300_000


def test_query(spark, sf):
    rows = QUERIES["op5_tool_call_messages"](spark, sf).collect()
    turns = {(r["conv_id"], r["turn"]): r for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    assert len(rows) == len(turns)
    place = {}
    for r in rows:
        turn = turns[r["conv_id"], r["turn"]]
        assert r["kind"] == {"user": 1, "assistant": 2}.get(turn["role"], 0)
        message = json.loads(r["message"])
        assert r["message"] == t.canonical(message)
        text = json.loads(message["tool_calls"][0]["function"]["arguments"])["question"] if r["kind"] == 1 else message["content"]
        assert text == turn["text"]
        place[r["conv_id"], r["kind"], r["call_id"]] = (r["at"], r["level"], r["kind"])
        if r["kind"] == 1:
            assert r["linked"] == (turns.get((r["conv_id"], r["turn"] + 1), {"role": ""})["role"] == "assistant")
    for (conv, kind, call), at in place.items():
        if kind == 2 and (conv, 1, call) in place:
            assert place[conv, 1, call] < at


def test_half_a_surrogate_pair_is_an_error_of_its_row(spark):
    calls = [(1, 1, "a", "f", '{"x":"\\ud800"}'), (1, 2, "b", "f", '{"x":1,"\\udfff":2}'), (1, 3, "c", "f", '{"x":{"$ref":"\\ud800"}}'), (1, 4, "d", "f", '{"x":"\\ud83d\\ude00"}')]
    rows = linked(spark, calls, [(1, 5, k, "r") for k in "abcd"])
    errors = {r["call_id"]: r["errors"] for r in rows if r["kind"] == 1}
    assert errors == {k: ["arguments are not text"] for k in "abc"} | {"d": []}
    kept = next(json.loads(r["message"]) for r in rows if r["call_id"] == "a" and r["kind"] == 1)
    assert kept["tool_calls"][0]["function"]["arguments"] == '{"x":"\\ud800"}'


def test_a_null_conversation_is_no_other_one(spark):
    schema = CALLS.replace("conv_id long", "conv_id string")
    calls = spark.createDataFrame([(None, 1, "a", "f", '{"x":1}'), ("-", 1, "a", "f", '{"x":2}'), ("-\x1fa", 1, "b", "f", '{"x":3}'), ("-", 1, "a\x1fb", "f", '{"x":4}')], schema)
    results = spark.createDataFrame([(None, 2, "a", "null's"), ("-", 2, "a", "dash's"), ("-\x1fa", 2, "b", "r"), ("-", 2, "a\x1fb", "r")], RESULTS.replace("conv_id long", "conv_id string"))
    rows = t.link(calls, results, SCHEMAS).collect()
    assert len(rows) == 8 and all(r["linked"] and r["valid"] for r in rows)
