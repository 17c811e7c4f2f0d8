from __future__ import annotations

import json

from drapekit.llm import chat_format as op

SCHEMA = "conv_id long, turn long, role string, text string, id int, status string"


def calls(*items):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "after"), i)) for i in items]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


def run(spark, rows):
    return op.format_chats(frame(spark, rows)).collect()


def test_linking_order_validation_and_json(spark):
    rows = [
        (1, 0, "user", 'say "hi"\né'),
        (1, 1, "assistant", calls(("b", "search", {"query": "x", "limit": 3}, None), ("c", "search", {"limit": "3", "q": 1}, "b"))),
        (1, 2, "tool", result("b", "found")),
        (1, 2, "tool", result("b", "later")),
        (1, 3, "assistant", calls(("d", "fetch_turn", {"turn": 1, "deep": True}, "c"), ("e", "nope", {}, "zz"), ("f", "count_words", [1], None))),
        (1, 3, "tool", result("d", "early")),
        (1, 4, "tool", result("nobody", None)),
        (1, 5, "assistant", calls((None, "search", {"query": "y"}, None), ("b", "search", {"query": "again"}, None))),
        (1, 6, "tool", json.dumps({"content": "no id"})),
        (2, 0, "assistant", calls(("b", "search", {"query": 5}, "c"), ("c", "search", {"query": "z"}, "b"), ("k", "search", {"query": "z"}, "c"))),
        (2, 1, "assistant", "not json"),
        (2, 1, None, None),
    ]
    got = {(r.conv_id, r.kind, r.call_id, r.turn, r.result_turn): r for r in run(spark, rows)}
    b = got[1, "call", "b", 1, 2]
    assert (b.depth, b.status, b.errors, b.n_calls, b.n_results) == (0, "linked", "", 2, 2)
    assert b.json == '{"arguments":{"limit":3,"query":"x"},"content":"found","conversation":1,"depth":0,"id":"b","name":"search","result_turn":2,"status":"linked","turn":1}'
    c = got[1, "call", "c", 1, None]
    assert (c.depth, c.status, c.errors) == (1, "pending", "missing:query,type:limit,unknown:q")
    d = got[1, "call", "d", 3, 3]
    assert (d.depth, d.status, d.errors) == (2, "early", "")
    assert (got[1, "call", "e", 3, None].depth, got[1, "call", "e", 3, None].errors) == (0, "unknown_tool")
    assert got[1, "call", "f", 3, None].errors == "arguments"
    assert got[1, "result", "nobody", None, 4].status == "orphan"
    assert got[1, "call", None, 5, None].status == "no_id" and got[1, "result", None, None, 6].status == "no_id"
    assert got[2, "call", "b", 0, None].errors == "type:query"
    assert [got[2, "call", i, 0, None].depth for i in "bck"] == [None] * 3
    m = got[1, "message", None, 0, None]
    assert m.json == '{"content":"say \\"hi\\"\\né","conversation":1,"role":"user","turn":0}'
    assert json.loads(got[2, "message", None, 1, None].json) in ({"content": "not json", "conversation": 2, "role": "assistant", "turn": 1}, {"conversation": 2, "turn": 1})
    assert len(run(spark, rows)) == 9 + 2 + 3
    for r in got.values():
        keys = list(json.loads(r.json))
        assert keys == sorted(keys)


def test_depth_of_a_long_chain(spark):
    n = 300
    rows = [(9, k, "assistant", calls((f"c{k}", "search", {"query": "q"}, f"c{k - 1}"))) for k in range(n)]
    assert {r.call_id: r.depth for r in run(spark, rows)} == {f"c{k}": k for k in range(n)}


def test_null_conversations_repeated_rows_and_empty(spark):
    rows = [(None, 0, "assistant", calls(("a", "search", {"query": "q"}, None))), (None, 1, "tool", result("a", "r"))] * 2
    (r,) = run(spark, rows)
    assert (r.conv_id, r.status, r.n_calls, r.n_results, r.depth) == (None, "linked", 2, 2, 0)
    assert run(spark, []) == []


def test_plan_is_native(spark):
    out = op.format_chats(frame(spark, [(1, 0, "user", "x")]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian"))


def test_every_call_and_result_is_in_the_output(spark):
    said = json.loads(calls(("z", "search", {"query": "beside"}, None))) | {"content": "I will look"}
    rows = [
        (1, 1, "assistant", calls(("b", "search", {"query": "one"}, None))),
        (1, 2, "tool", result("b", "found")),
        (1, 3, "tool", result("b", "later")),
        (1, 5, "assistant", calls(("b", "search", {"query": "again"}, "b"), ("c", "search", {"query": "on"}, "b"))),
        (1, 6, "tool", result("b", "last")),
        (None, 0, "tool", result("n", "too soon")),
        (None, 1, "assistant", calls(("n", "search", {"query": "q"}, None))),
        (None, 2, "tool", result("n", "valid")),
        (2, 0, "assistant", json.dumps(said)),
        (2, 1, "assistant", json.dumps({"content": "no calls", "tool_calls": []})),
    ]
    out = op.format_chats(frame(spark, rows), every=True)
    got = {(r.conv_id, r.kind, r.call_id, r.turn, r.result_turn): (r.status, r.depth, r.n_calls, r.n_results, json.loads(r.json).get("content")) for r in out.collect()}
    assert got == {
        (1, "call", "b", 1, 2): ("linked", 0, 2, 3, "found"),
        (1, "call", "b", 5, 3): ("early", 1, 2, 3, "later"),
        (1, "result", "b", None, 6): ("extra", None, 2, 3, "last"),
        (1, "call", "c", 5, None): ("pending", 2, 1, 0, None),
        (None, "call", "n", 1, 0): ("early", 0, 1, 2, "too soon"),
        (None, "result", "n", None, 2): ("extra", None, 1, 2, "valid"),
        (2, "call", "z", 0, None): ("pending", 0, 1, 0, None),
        (2, "message", None, 0, None): ("message", None, 0, 0, "I will look"),
        (2, "message", None, 1, None): ("message", None, 0, 0, json.dumps({"content": "no calls", "tool_calls": []})),
    }
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian"))


def test_malformed_arguments_stay_and_whole_numbers_are_integers(spark):
    rows = [(1, k, "assistant", json.dumps({"tool_calls": [{"id": f"i{k}", "name": "search", "arguments": a}]})) for k, a in enumerate(['{"bad json KEEPME', '{"query":"x","query":"y"}', '{"limit":1.0,"query":"x"}', '{"limit":1.5,"query":"x"}', "[1]"])]
    out = op.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), every=True).orderBy("turn").collect()
    got = [json.loads(r.json) for r in out]
    assert [g.get("raw_arguments") for g in got] == ['{"bad json KEEPME', '{"query":"x","query":"y"}', None, None, "[1]"]
    assert [r.errors for r in out] == ["arguments", "arguments", "", "type:limit", "arguments"]
    assert got[2]["arguments"] == {"limit": 1, "query": "x"}
