import json

import pytest
from pyspark.sql import functions as F

from gaugeline.llm.tool_calls import CALL, RESULT, argument_problems, chat_samples, link_calls, link_conversations

SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}, "list": {"items": ("array", True), "by": ("object", False)}}
CHAT = "conv_id long, turn long, role string, text string"


def linked(spark, calls, results=()):
    frame = link_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame(list(results), RESULT), SCHEMAS)
    return sorted(frame.collect(), key=lambda r: (r.conv_id or 0, r.position is None, r.position or 0, r.status, r.turn or 0))


@pytest.mark.parametrize(
    ("name", "arguments", "want"),
    [
        ("add", '{"a":1,"b":2.5}', []),
        ("add", '{"a":1,"b":2,"note":"x"}', []),
        ("add", '{"a":1.5,"b":"2"}', ["wrong type of a", "wrong type of b"]),
        ("add", '{"b":1e3,"z":1,"c":null}', ["missing a", "unknown c", "unknown z"]),
        ("add", '{"a":null,"b":2}', ["wrong type of a"]),
        ("add", "[1]", ["no JSON object"]),
        ("add", "{", ["no JSON object"]),
        ("add", None, ["no JSON object"]),
        ("none", "{}", ["unknown tool"]),
        (None, "{}", ["unknown tool"]),
        ("list", '{"items":[1,{"x":2}],"by":{}}', []),
        ("list", '{"items":{}}', ["wrong type of items"]),
    ],
)
def test_arguments_are_checked(spark, name, arguments, want):
    row = spark.createDataFrame([(name, arguments)], "name string, arguments string")
    assert row.select(argument_problems(F.col("name"), F.col("arguments"), SCHEMAS)).first()[0] == want


def test_calls_and_results_meet(spark):
    good = '{"b":2,"a":1}'
    calls = [(1, "x", 1, "add", good, None), (1, "y", 3, "add", good, ["x"]), (1, "x", 5, "add", good, []), (2, "x", 1, "add", good, ["nowhere"])]
    results = [(1, "x", 2, "é \"q\"\n"), (1, "x", 4, "again"), (1, "z", 4, "lost"), (3, "x", 1, None), (None, "x", 1, "no chat")]
    found = linked(spark, calls, results)
    assert [(r.conv_id, r.call_id, r.position, r.status, r.problems, r.valid) for r in found] == [
        (None, "x", None, "orphan", "", False),
        (1, "x", 0, "answered", "", True),
        (1, "y", 1, "unanswered", "", True),
        (1, "x", None, "duplicate", "", False),
        (1, "x", None, "duplicate", "", False),
        (1, "z", None, "orphan", "", False),
        (2, "x", 0, "unanswered", "unknown need", False),
        (3, "x", None, "orphan", "", False),
    ]
    assert found[1].json == '{"arguments":{"a":1,"b":2},"id":"x","name":"add","result":"é \\"q\\"\\n"}'


def test_positions_follow_needs(spark):
    good = '{"a":1,"b":2}'
    calls = [(1, "c", 1, "add", good, ["b"]), (1, "b", 2, "add", good, ["a", "d"]), (1, "a", 3, "add", good, []), (1, "d", 3, "add", good, [])]
    calls += [(2, "p", 1, "add", good, ["q"]), (2, "q", 2, "add", good, ["p"]), (2, "r", 3, "add", good, ["q"]), (2, "s", 4, "add", good, None)]
    calls += [(3, "own", 1, "add", good, ["own"]), (4, "n", 1, "add", good, [None])]
    found = linked(spark, calls)
    assert [(r.call_id, r.position) for r in found if r.conv_id == 1] == [("a", 0), ("d", 1), ("b", 2), ("c", 3)]
    assert [(r.call_id, r.position, r.status) for r in found if r.conv_id == 2] == [
        ("s", 0, "unanswered"), ("p", None, "cyclic"), ("q", None, "cyclic"), ("r", None, "cyclic"),
    ]
    assert [(r.position, r.status) for r in found if r.conv_id == 3] == [(None, "cyclic")]
    assert [r.position for r in found if r.conv_id == 4] == [0]


def test_chats_with_calls_and_turns(spark):
    call = {"tool_calls": [{"id": "k1", "name": "reply", "arguments": json.dumps({"turn": 9, "text": "hi"}), "needs": ["turn-0"]}]}
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", json.dumps(call)), (1, 2, "tool", json.dumps({"tool_call_id": "k1", "content": "r"}))]
    rows += [(2, 0, "system", "s"), (2, 1, "user", None), (2, 2, "assistant", "x" * 50_000), (3, 0, "assistant", "first"), (None, None, None, None)]
    found = link_conversations(spark.createDataFrame(rows, CHAT).selectExpr("*", "1 AS level", "2 AS status"))
    assert sorted((r.conv_id, r.call_id, r.status, r.problems) for r in found.collect()) == [
        (1, "k1", "answered", ""), (1, "turn-0", "unanswered", ""), (2, "turn-1", "answered", "missing text"), (3, "turn--1", "orphan", ""),
    ]
    samples = {r.conv_id: json.loads(r.json) for r in chat_samples(found).collect()}
    assert [c["id"] for c in samples[1]] == ["turn-0", "k1"]
    assert link_conversations(spark.createDataFrame([], CHAT)).count() == 0


def test_the_main_path_is_native(spark):
    plan = link_conversations(spark.createDataFrame([(1, 0, "user", "q")], CHAT))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_unreadable_messages_have_rows(spark):
    calls = '{"tool_calls": [{"id": "a", "name": "reply", "arguments": "{}"}]}'
    rows = [
        (1, 0, "system", "s"), (1, 1, "assistant", '{"tool_calls": [{'), (1, 2, "assistant", '{"tool_calls": []}'), (1, 3, "assistant", '{"tool_calls": [null]}'),
        (1, 4, "tool", "oops"), (1, 5, "tool", '{"content": "x"}'), (1, 6, "tool", None), (1, 7, "assistant", calls), (1, 8, "tool", '{"tool_call_id": "a", "content": "r"}'),
    ]
    found = {r.turn: r for r in link_conversations(spark.createDataFrame(rows, CHAT)).collect()}
    assert {k: (r.status, r.problems) for k, r in found.items() if k < 7} == dict.fromkeys((1, 2, 3), ("unreadable", "unreadable calls")) | dict.fromkeys(
        (4, 5, 6), ("unreadable", "unreadable result")
    )
    assert not any(r.valid for r in found.values() if r.status == "unreadable")
    assert found[7].status == "answered"
    assert found[4].json == '{"result":"oops"}' and found[6].json == "{}"
    assert len(found) == 7
