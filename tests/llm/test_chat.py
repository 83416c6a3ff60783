import json
from collections import defaultdict

from outletlab.llm import chat
from outletlab.llm.queries import QUERIES
from tests.llm.conftest import SF


def test_query_equals_brute_force(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    calls, answers = {}, defaultdict(list)
    for r in turns:
        if r.role == "assistant":
            answers[(r.conv_id, r.turn - 1)].append(r.text)
        else:
            calls[(r.conv_id, r.turn)] = r
    want = {}
    for key in {*calls, *answers}:
        r, position, at = calls.get(key), 0, key
        while r is not None and (at[0], at[1] - 2) in calls:
            position, at = position + 1, (at[0], at[1] - 2)
        ident = f"{key[0]}-{key[1]}"
        errors = [] if r is not None else ["result without a call"]
        if r is not None and not r.text:
            errors = ["$.text: shorter than 1"]
        record = {"id": ident, "name": r and {"user": "ask", "system": "configure"}.get(r.role, r.role),
                  "arguments": r and {"text": r.text or "", "turn": r.turn}, "after": r and f"{key[0]}-{key[1] - 2}",
                  "position": position if r else None, "result": min(answers[key], default=None), "errors": errors}
        want[(key[0], ident)] = (len(answers[key]), not errors, json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
    got = {(r.conv_id, r.call_id): (r.n_results, r.valid, r.json) for r in QUERIES["op10_chat_format"](spark, SF).collect()}
    assert got == want


def frames(spark, calls, results):
    return (spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, name string, arguments string, position string, called string"),
            spark.createDataFrame(results, "conv_id long, call_id string, content string, n_results string"))


TOOL = {"add": {"type": "object", "required": ["a", "b"], "additionalProperties": False,
                "properties": {"a": {"type": "integer"}, "b": {"type": ["number", "null"]}, "tags": {"type": "array", "items": {"type": "string"}}}}}


def test_linking_order_and_validation(spark):
    ok = '{"b":2.5,"a":1}'
    calls = [(1, "c", "b", "add", ok, "", ""), (1, "a", None, "add", ok, "", ""), (1, "b", "a", "add", '{"a":true,"x":1}', "", ""),
             (1, "p", "q", "add", ok, "", ""), (1, "q", "p", "add", ok, "", ""), (1, "r", "q", "add", ok, "", ""), (1, "d", "nowhere", "sub", "{}", "", ""),
             (2, "a", None, "add", "{", "", ""), (2, "a2", None, "add", None, "", ""), (3, "s", "s", "add", ok, "", ""),
             (4, "a", None, "add", ok, "", ""), (4, "a", None, "add", ok, "", ""), (None, "a", None, "add", ok, "", ""), (5, None, None, "add", ok, "", "")]
    results = [(1, "a", "3.5", ""), (4, "a", "z", ""), (4, "a", "y", ""), (9, "lost", "?", ""), (None, "a", "n", "")]
    got = {(r.conv_id, r.call_id): r for r in chat.format_tool_calls(*frames(spark, calls, results), TOOL).collect()}
    assert {k: got[1, k].position for k in "abcdpqr"} == {"a": 0, "b": 1, "c": 2, "d": 0, "p": None, "q": None, "r": None}
    assert got[1, "a"].valid and json.loads(got[1, "a"].json)["result"] == "3.5"
    assert got[1, "b"].errors == "$: lacks b; $.a: not of type integer; $: unknown x"
    assert got[1, "d"].errors == "unknown tool" and got[1, "r"].errors == "cycle of calls" and got[3, "s"].errors == "cycle of calls"
    assert got[2, "a"].errors == got[2, "a2"].errors == "arguments are not JSON"
    assert (got[4, "a"].n_results, json.loads(got[4, "a"].json)["result"]) == (2, "y")
    assert (got[4, "a"].n_calls, got[4, "a"].errors) == (2, "results of this id differ") and got[1, "a"].n_calls == 1
    assert got[9, "lost"].name is None and not got[9, "lost"].valid and got[9, "lost"].n_calls == 0
    assert len(got) == 12 and '"arguments":{"a":1,"b":2.5}' in got[1, "a"].json


def test_long_chain_and_hub(spark):
    """A chain of 300 calls needs nine rounds; 300 calls may follow one."""
    ok = '{"a":1,"b":null}'
    calls = [(1, f"k{i}", f"k{i - 1}", "add", ok, "", "") for i in range(300)] + [(1, f"h{i}", "k5", "add", ok, "", "") for i in range(300)]
    got = {r.call_id: r.position for r in chat.format_tool_calls(*frames(spark, calls, [(1, "k7", "x", "")]), TOOL).collect()}
    assert all(got[f"k{i}"] == i for i in range(300)) and all(got[f"h{i}"] == 6 for i in range(300))


def test_repeated_rows_that_differ_are_counted_and_flagged(spark):
    ok, other = '{"a":1,"b":null}', '{"a":2,"b":null}'
    calls = [(1, "a", None, "add", ok, "", ""), (1, "a", None, "add", other, "", ""), (1, "a", None, None, ok, "", ""),
             (1, "b", None, "add", ok, "", ""), (1, "b", None, "add", ok, "", "")]
    results = [(1, "b", "x", ""), (1, "b", "x", ""), (2, "c", None, ""), (2, "c", "y", "")]
    got = {(r.conv_id, r.call_id): r for r in chat.format_tool_calls(*frames(spark, calls, results), TOOL).collect()}
    assert got[1, "a"].n_calls == 3 and "calls of this id differ" in got[1, "a"].errors and not got[1, "a"].valid
    assert (got[1, "b"].n_calls, got[1, "b"].n_results, got[1, "b"].valid) == (2, 2, True)
    assert got[2, "c"].errors == "result without a call; results of this id differ"


def test_empty(spark):
    calls, results = frames(spark, [(1, "a", None, "add", "{}", "", "")], [(1, "a", "x", "")])
    assert chat.format_tool_calls(calls.limit(0), results.limit(0), TOOL).collect() == []
    assert chat.format_tool_calls(calls, results.limit(0), TOOL).first().errors == "$: lacks a; $: lacks b"
    assert chat.format_tool_calls(calls.limit(0), results, TOOL).first().errors == "result without a call"


def test_turns_with_nulls(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", None), (1, 2, "tool", "x"), (None, 0, "user", "y"), (1, None, "user", "z"), (1, 4, None, "w")]
    got = {r.call_id: r for r in chat.format_tool_calls(*chat.turn_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")),
                                                        chat.TURN_SCHEMAS).collect()}
    assert got["1-0"].errors == "$.text: shorter than 1" and got["1-2"].errors == "unknown tool" and got["1-4"].errors == "unknown tool"
    assert set(got) == {"1-0", "1-2", "1-4"}
