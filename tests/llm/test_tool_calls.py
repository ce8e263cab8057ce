"""Tool calls: linking, order, validation, canonical form."""

import json

import pytest

from ruleweave.llm import tool_calls

SCHEMAS = {
    "add": {
        "type": "object",
        "required": ["a", "b"],
        "properties": {"a": {"type": "integer"}, "b": {"type": "number", "minimum": 0}, "tags": {"type": "array", "items": {"type": "string"}}},
        "additionalProperties": False,
    },
    "say": {"type": "object", "properties": {"mood": {"enum": ["good", "bad"]}}},
}
CALLS = "conv long, call_id string, position long, name string, arguments string, depends_on array<string>, extra int"
RESULTS = "conv long, call_id string, content string, position string"


@pytest.mark.parametrize(
    "value, errors",
    [
        ({"a": 1, "b": 2.5}, []),
        ({"a": 1, "b": 2, "tags": ["x", 1]}, ["$.tags[1]: not string"]),
        ({"a": True, "b": -1}, ["$.a: not integer", "$.b: below minimum"]),
        ({"b": 1, "c": 0}, ["$.a: missing", "$.c: unknown"]),
        ([], ["$: not object"]),
    ],
)
def test_violations(value, errors):
    assert tool_calls.violations(value, SCHEMAS["add"]) == errors


def test_type_lists_and_schemas_of_other_properties():
    schema = {"type": ["object", "null"], "additionalProperties": {"type": ["string", "null"]}}
    assert tool_calls.violations(None, schema) == tool_calls.violations({"a": None, "b": "x"}, schema) == []
    assert tool_calls.violations({"a": 1}, schema) == ["$.a: not string or null"]
    assert tool_calls.violations(1, schema) == ["$: not object or null"]


@pytest.mark.parametrize(
    "schema",
    [
        {"maximum": 3},
        {"properties": {"a": {"pattern": "x"}}},
        {"items": {"anyOf": []}},
        {"additionalProperties": {"$ref": "#"}},
        {"type": ["string", "text"]},
        {"items": [{}]},
    ],
)
def test_schemas_that_are_not_checked_in_full_are_refused(schema):
    with pytest.raises(ValueError):
        tool_calls.link_tool_calls(None, None, {"say": schema})


def test_results_without_a_call_are_returned(spark):
    calls = spark.createDataFrame([(1, "a", 0, "say", "{}", [], 0)], CALLS)
    contents = [(1, "a", "r"), (1, "b", "y"), (1, "b", "x"), (9, "a", "z"), (None, "n", "w")]
    results = spark.createDataFrame([(*r, "p") for r in contents], RESULTS)
    rows = tool_calls.link_tool_calls(calls, results, SCHEMAS, orphans=True).collect()
    got = {(r.conv, r.call_id): r for r in rows}
    assert {k: (r.status, r.copies, r.errors) for k, r in got.items()} == {
        (1, "a"): ("ok", 1, ""), (1, "b"): ("no_call", 0, ""), (9, "a"): ("no_call", 0, ""), (None, "n"): ("unlinked", 0, ""),
    }
    assert json.loads(got[1, "b"].json)["result"] == "x" and json.loads(got[None, "n"].json)["result"] == "w"


def test_canonical_form_ignores_key_order():
    assert tool_calls.canonical({"b": [1, {"z": "é", "a": None}], "a": 1.5}) == '{"a":1.5,"b":[1,{"a":null,"z":"é"}]}'


def linked(spark, calls, results):
    calls = spark.createDataFrame([(*c, 0) for c in calls], CALLS)
    results = spark.createDataFrame([(*r, "p") for r in results], RESULTS)
    return {(r.conv, r.call_id): r for r in tool_calls.link_tool_calls(calls, results, SCHEMAS).collect()}


def test_statuses(spark):
    good = '{"b": 2, "a": 1}'
    got = linked(
        spark,
        [
            (1, "ok", 0, "add", good, None),
            (1, "bad", 1, "add", '{"a": "x", "b": 1}', []),
            (1, "broken", 2, "add", "{", []),
            (1, "nan", 3, "say", '{"x": NaN}', []),
            (1, "alone", 4, "say", "{}", ["ok"]),
            (1, "twice", 5, "say", '{"mood": "good"}', ["absent", None]),
            (1, "who", 6, "sing", "{}", []),
            (1, "same", 8, "add", good, []),
            (1, "same", 7, "say", "{}", []),
            (2, "ok", None, "say", None, []),
            (None, "x", 0, "say", "{}", []),
            (3, None, 0, "say", "{}", []),
        ],
        [(1, c, "r") for c in ("ok", "bad", "broken", "nan", "who", "same")] + [(1, "twice", "b"), (1, "twice", "a"), (9, "z", "lost"), (None, "x", "n")],
    )
    status = {k[1]: r.status for k, r in got.items() if k[0] == 1}
    assert status == {
        "ok": "ok", "bad": "invalid", "broken": "invalid", "nan": "invalid", "alone": "no_result", "twice": "ambiguous", "who": "invalid", "same": "ok",
    }
    assert got[1, "ok"].json == '{"arguments":{"a":1,"b":2},"id":"ok","name":"add","result":"r"}'
    assert json.loads(got[1, "twice"].json)["result"] == "a"
    assert got[1, "same"].copies == 2 and json.loads(got[1, "same"].json)["name"] == "say"
    assert got[None, "x"].status == got[3, None].status == "unlinked" and got[2, "ok"].status == "invalid"


def test_order_is_topological(spark):
    calls = [
        (1, "a", 0, "say", "{}", ["c"]),
        (1, "b", 1, "say", "{}", ["a", "c"]),
        (1, "c", 2, "say", "{}", []),
        (1, "d", 3, "say", "{}", ["b"]),
        (2, "x", 0, "say", "{}", ["y"]),
        (2, "y", 1, "say", "{}", ["x"]),
        (2, "z", 2, "say", "{}", ["y"]),
        (2, "free", 3, "say", "{}", []),
        (3, "p", 0, "say", "{}", []),
        (3, "q", 1, "say", "{}", ["p", "q0"]),
        (4, "self", 0, "say", "{}", ["self"]),
    ]
    got = linked(spark, calls, [(c[0], c[1], "r") for c in calls])
    assert {k[1]: r.level for k, r in got.items() if k[0] == 1} == {"c": 0, "a": 1, "b": 2, "d": 3}
    assert {k[1]: r.status for k, r in got.items() if k[0] in (2, 4)} == {"x": "cycle", "y": "cycle", "z": "cycle", "free": "ok", "self": "cycle"}
    assert {r.level for k, r in got.items() if k[0] == 3} == {0}


def test_empty_tables(spark):
    assert linked(spark, [], []) == {}
    assert linked(spark, [], [(1, "a", "r")]) == {}


@pytest.mark.parametrize(
    "arguments, status, text",
    [
        ('{"a":"\\ud800"}', "ok", '"arguments":{"a":"\\ud800"}'),
        ('{"\\udfff":1}', "ok", '"arguments":{"\\udfff":1}'),
        ('{"a":"\\ud83d\\ude00"}', "ok", '"arguments":{"a":"\U0001f600"}'),
        ('{"a":1e999}', "invalid", None),
        ('{"a":NaN}', "invalid", None),
        ('{"a":' + "9" * 2_000 + "}", "invalid", None),
        ("[" * 100_000, "invalid", None),
        ('{"a":1e2,"b":100.0,"c":100,"d":-0.0,"e":1.50}', "ok", '"arguments":{"a":100,"b":100,"c":100,"d":0,"e":1.5}'),
        ('{"mood":"\\ud800"}', "invalid", '"arguments":{"mood":"\\ud800"}'),
        (None, "invalid", None),
    ],
)
def test_odd_arguments_end_no_job(spark, arguments, status, text):
    calls = spark.createDataFrame([(1, "a", 0, "say", arguments, [], 0), (1, "b", 1, "say", "{}", [], 0)], CALLS)
    results = spark.createDataFrame([(1, "a", "done", ""), (1, "b", "done", "")], RESULTS)
    rows = {r.call_id: r for r in tool_calls.link_tool_calls(calls, results, SCHEMAS).collect()}
    assert rows["b"].status == "ok" and rows["a"].status == status
    assert text in rows["a"].json if text else "arguments" not in rows["a"].json
    json.loads(rows["a"].json)


def test_numbers_and_truth_values():
    assert tool_calls.violations(tool_calls.parse("1.0"), {"type": "integer"}) == []
    assert tool_calls.violations(tool_calls.parse("1.5"), {"type": "integer"}) == ["$: not integer"]
    assert tool_calls.violations(True, {"enum": [1]}) == ["$: not in enum"]
    assert tool_calls.violations(tool_calls.parse("1e0"), {"enum": [1.0]}) == []
    assert tool_calls.violations(False, {"minimum": 1}) == []


def test_columns_with_clashing_names(spark):
    calls = spark.createDataFrame([(1, "a", 0, "say", "{}", ["a0"], 0), (1, "a0", 1, "say", "{}", [], 0)], CALLS)
    calls = calls.selectExpr("*", "1 as level", "2 as status", "3 as copies", "4 as _results", "5 as result", "6 as json")
    results = spark.createDataFrame([(1, "a", "done", "")], RESULTS).selectExpr("*", "1 as copies", "2 as name")
    rows = {r.call_id: (r.status, r.level) for r in tool_calls.link_tool_calls(calls, results, SCHEMAS).collect()}
    assert rows == {"a": ("ok", 1), "a0": ("no_result", 0)}


@pytest.mark.parametrize("size", [10**6, 3])
def test_a_hot_conversation_and_a_call_that_many_need(spark, monkeypatch, size):
    from ruleweave.operators import stages

    monkeypatch.setattr(stages, "ROWS_PER_PIECE", size)
    rows = [(1, f"c{i}", i, "say", "{}", ["c59"] if i < 40 else [], 0) for i in range(60)]
    rows += [(2, f"c{i}", i, "say", "{}", [f"c{i - 1}"] if i else [], 0) for i in range(20)]
    found = tool_calls.link_tool_calls(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect()
    levels = {(r.conv, r.call_id): r.level for r in found}
    assert len(found) == 80 and all(levels[1, f"c{i}"] == (1 if i < 40 else 0) for i in range(60))
    assert all(levels[2, f"c{i}"] == 0 for i in range(20))
