import json

import pytest

from toxiscope.llm import toolcalls

SCHEMA = "conv_id long, turn long, role string, text string, position int, status string, event long"
TOOLS = {
    "add": {"required": ["a", "b"], "additionalProperties": False,
            "properties": {"a": {"type": "integer"}, "b": {"type": "number"}, "unit": {"type": "string", "enum": ["m", "s"]}}},
    "say": {"properties": {"text": {"type": "string", "minLength": 3}, "to": {"type": "array"}, "how": {"type": "object"},
                           "now": {"type": "boolean"}}},
}


def call(ident, name="say", args=None, after=None):
    args = {"text": "hello"} if args is None else args
    return {"id": ident, "name": name, "arguments": args, **({"after": after} if after else {})}


def message(conv, turn, *calls):
    return (conv, turn, "assistant", json.dumps({"tool_calls": list(calls)}), 1, "x", 1)


def result(conv, turn, ident, content="ok"):
    return (conv, turn, "tool", json.dumps({"tool_call_id": ident, "content": content}), 1, "x", 1)


def run(spark, rows, tools=TOOLS):
    out = toolcalls.link_tool_calls(spark.createDataFrame(rows, SCHEMA), tools).collect()
    return sorted(out, key=lambda r: (r.conv_id is not None, r.conv_id, r.position))


def test_links_order_and_statuses(spark):
    rows = [
        (1, 0, "user", "hi", 1, "x", 1),
        message(1, 1, call("b", after=["c", "missing"]), call("c")),
        result(1, 2, "b"),
        result(1, 0, "c", "early"),
        result(1, 3, "nobody"),
        result(1, 4, "b", "again"),
        message(1, 5, call("d"), call("b")),
        message(2, 0, call("x", after=["y"])),
        message(2, 1, call("y", after=["z"])),
        message(2, 2, call("z")),
        result(2, 3, "x"),
        message(3, 0, call("p", after=["q"]), call("q", after=["p"]), call("r", after=["p"]), call("s")),
        message(4, 0, call(None)),
    ]
    got = run(spark, rows)
    by = {(r.conv_id, r.kind, r.call_id, r.turn): r for r in got}
    assert by[1, "call", "b", 1].status == "linked" and by[1, "call", "b", 1].linked_turn == 2
    assert by[1, "call", "c", 1].status == "linked" and by[1, "call", "c", 1].linked_turn == 0
    assert by[1, "result", "nobody", 3].status == "orphan"
    assert by[1, "result", "b", 4].status == "duplicate" and by[1, "call", "b", 5].status == "duplicate"
    assert by[1, "call", "d", 5].status == "unanswered" and by[4, "call", None, 0].status == "nameless"
    assert {by[3, "call", i, 0].status for i in "pqr"} == {"cycle"} and by[3, "call", "s", 0].status == "unanswered"
    place = {k: r.position for k, r in by.items()}
    assert place[1, "call", "c", 1] < place[1, "call", "b", 1] < place[1, "result", "b", 2]
    assert place[1, "call", "c", 1] < place[1, "result", "c", 0]
    assert place[2, "call", "z", 2] < place[2, "call", "y", 1] < place[2, "call", "x", 0] < place[2, "result", "x", 3]
    for conv in (1, 2, 3, 4):
        own = [r.position for r in got if r.conv_id == conv]
        assert own == list(range(len(own)))


@pytest.mark.parametrize("name,args,fault", [
    ("add", {"a": 1, "b": 2.5}, ""), ("add", {"b": 2, "a": 1, "unit": "m"}, ""), ("add", {"a": 1}, "missing:b"),
    ("add", {"a": 1.5, "b": 1}, "type:a"), ("add", {"a": 1, "b": "x"}, "type:b"), ("add", {"a": 1, "b": 1, "c": 1}, "extra"),
    ("add", {"a": 1, "b": 1, "unit": "kg"}, "enum:unit"), ("say", {"text": "ab"}, "short:text"), ("say", {}, ""),
    ("say", {"to": [1], "how": {"x": 1}, "now": True}, ""), ("say", {"to": "a", "how": [], "now": 1}, "type:to,type:how,type:now"),
    ("fly", {}, "unknown_tool"), ("say", "not json", "json"), ("say", "[1]", "json"), (None, {}, "unknown_tool"),
])
def test_arguments_against_schemas(spark, name, args, fault):
    got = run(spark, [message(1, 0, call("a", name, args))])
    assert got[0].problems == fault


def test_canonical_json(spark):
    args = {"text": "ä \"q\" \n \\ [x]", "how": {"z": 1, "a": [3, {"y": None, "b": 2}]}}
    rows = [message(1, 0, call("a", "say", args, ["k", "b"])), result(1, 1, "a", "[done]"), (1, 2, "user", "[hi]", 1, "x", 1),
            message(1, 3, call("t", "say", "plain text"))]
    got = run(spark, rows)
    canon = lambda v: json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    want = [
        {"role": "assistant", "tool_calls": [{"after": ["b", "k"], "arguments": args, "id": "a", "name": "say"}]},
        {"content": "[done]", "role": "tool", "tool_call_id": "a"}, {"content": "[hi]", "role": "user"},
        {"role": "assistant", "tool_calls": [{"arguments": "plain text", "id": "t", "name": "say"}]},
    ]
    assert [r.json for r in got] == [canon(w) for w in want]


def test_messy_and_empty(spark):
    long_text = "word " * 200_000
    rows = [
        (None, None, None, None, None, None, None), (1, None, "user", None, 1, "x", 1), (1, 0, None, "{bad json", 1, "x", 1),
        (1, 0, "user", "", 1, "x", 1), (1, 0, "user", "", 1, "x", 1), (1, 0, "assistant", "{}", 1, "x", 1),
        (1, 1, "user", long_text, 1, "x", 1), (None, 2, "tool", '{"tool_call_id": "a"}', 1, "x", 1), message(None, 1, call("a")),
        message(1, 2), (1, 3, "tool", '{"content": "no id"}', 1, "x", 1),
    ]
    got = run(spark, rows)
    assert len(got) == len(rows)
    none = [r for r in got if r.conv_id is None]
    assert sorted(r.status for r in none) == ["linked", "linked", "message"]
    assert max(len(r.json) for r in got) > 1_000_000
    messages = toolcalls.as_tool_messages(spark.createDataFrame(rows, SCHEMA))
    assert toolcalls.link_tool_calls(messages, toolcalls.TOOLS).count() == len(rows)
    assert run(spark, []) == []


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame([message(1, 0, call("a"))], SCHEMA)
    plan = toolcalls.link_tool_calls(df, TOOLS)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
