"""Tool-call linking against plain Python."""

import json
import random

import pytest

from tests.conftest import SF
from tidemark.llm import chat
from tidemark.llm.chat import Parameter
from tidemark.llm.queries import op3_chat_tool_calls

TOOLS = {
    "add": {"a": Parameter("integer", minimum=0, maximum=9), "b": Parameter("number"), "note": Parameter("string", required=False, max_length=3)},
    "pick": {"one": Parameter("string", choices=("x", "y")), "many": Parameter("array", required=False), "o": Parameter("object", required=False),
             "f": Parameter("boolean", required=False)},
}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"


def run(spark, calls, results):
    rows = chat.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOLS).collect()
    return {(r.conv_id, r.call_id): r for r in rows}


@pytest.mark.parametrize(("name", "arguments", "errors"), [
    ("add", '{"b": 2.5, "a": 3}', []), ("add", '{"a": 3, "b": 1, "note": "abc"}', []), ("add", '{"a": 30, "b": 1, "note": "abcd"}', ["length:note", "maximum:a"]),
    ("add", '{"a": -1}', ["minimum:a", "missing:b"]), ("add", '{"a": "3", "b": true}', ["type:a", "type:b"]), ("add", '{"a": 1.5, "b": 1, "z": 0}', ["type:a", "unknown:z"]),
    ("add", "{broken", ["invalid_json"]), ("add", "[1]", ["invalid_json"]), ("add", None, ["invalid_json"]), ("other", "{}", ["unknown_tool"]), (None, "{}", ["unknown_tool"]),
    ("pick", '{"one": "x", "many": [1], "o": {"k": null}, "f": false}', []), ("pick", '{"one": "z", "many": {}, "o": [], "f": 0}', ["choice:one", "type:f", "type:many", "type:o"]),
    ("add", '{"a": null, "b": 1}', ["type:a"])])
def test_validation(spark, name, arguments, errors):
    row = run(spark, [(1, 0, "c", name, arguments, [])], [])[1, "c"]
    assert (row.errors, row.valid, row.status) == (errors, not errors, "missing_result")


def test_links_repeats_and_canonical_json(spark):
    calls = [(1, 2, "a", "add", ' { "b" : 2.5,\n "a":3 } ', []), (1, 5, "a", "add", "{}", []), (1, 4, "b", "pick", '{"one": "ä\\n"}', ["a", "zz", None]),
             (2, 1, "a", "add", '{"a":1,"b":1}', None), (None, 1, "n", "add", "{}", []), (1, 1, None, "add", "{}", [])]
    results = [(1, 3, "a", "three"), (1, 9, "a", "late"), (1, 6, "q", "lost"), (None, 1, "a", "x"), (1, 7, "b", None)]
    got = run(spark, calls, results)
    assert set(got) == {(1, "a"), (1, "b"), (1, "q"), (2, "a")}
    a = got[1, "a"]
    assert (a.status, a.turn, a.result_turn, a.level, a.n_calls, a.n_results) == ("linked", 2, 3, 0, 2, 2)
    assert a.message == '{"arguments":{"a":3,"b":2.5},"content":"three","id":"a","name":"add"}'
    assert got[1, "b"].errors == ["choice:one", "after:zz"] and json.loads(got[1, "b"].message)["arguments"] == {"one": "ä\n"}
    assert (got[1, "q"].status, got[1, "q"].valid, got[1, "q"].level) == ("orphan_result", None, None)
    assert got[2, "a"].status == "missing_result"


def test_topological_levels_and_cycles(spark):
    ok = '{"a":1,"b":1}'
    calls = [(1, 1, "c", "add", ok, ["b"]), (1, 2, "b", "add", ok, ["a"]), (1, 3, "a", "add", ok, []), (1, 4, "d", "add", ok, ["c", "a"]),
             (2, 1, "x", "add", ok, ["y"]), (2, 2, "y", "add", ok, ["x"]), (2, 3, "z", "add", ok, ["y"]), (2, 4, "w", "add", ok, []),
             (3, 1, "p", "add", ok, []), (3, 2, "q", "add", ok, ["p"]), (4, 1, "s", "add", ok, ["s"])]
    got = run(spark, calls, [(c[0], 9, c[2], "r") for c in calls])
    assert {k[1]: r.level for k, r in got.items() if k[0] == 1} == {"a": 0, "b": 1, "c": 2, "d": 3}
    assert {k[1]: (r.level, r.status) for k, r in got.items() if k[0] == 2} == {
        "x": (None, "cyclic"), "y": (None, "cyclic"), "z": (None, "cyclic"), "w": (0, "linked")}
    assert [got[3, "p"].level, got[3, "q"].level, got[4, "s"].status] == [0, 0, "cyclic"]
    for conv in (1, 3):  # sorting by (level, turn) puts every call after those it names
        order = [r.call_id for r in sorted((r for k, r in got.items() if k[0] == conv), key=lambda r: (r.level, r.turn))]
        for c in calls:
            if c[0] == conv:
                assert all(order.index(d) < order.index(c[2]) for d in c[5])


def plain_depths(calls):
    """Depth of every (conv_id, call_id); none on a cycle or behind one."""
    named = {(c[0], c[2]): [(c[0], d) for d in c[5] or []] for c in calls}
    named = {k: [d for d in deps if d in named] for k, deps in named.items()}
    out = {}
    while ready := [k for k, deps in named.items() if k not in out and all(d in out for d in deps)]:
        out |= {k: max([out[d] + 1 for d in named[k]], default=0) for k in ready}
    return {k: out.get(k) for k in named}


def test_depth_of_every_call_in_turn_order_too(spark):
    ok, rng = '{"a":1,"b":1}', random.Random(4)
    calls = [(1, t, f"c{t}", "add", ok, [f"c{t - 1}"] if t else []) for t in range(40)]  # a chain, in turn order
    calls += [(2, t, f"c{t}", "add", ok, [f"c{t - i}" for i in (1, 2, 5) if t >= i]) for t in range(12)]  # several names
    calls += [(3, t, f"c{t}", "add", ok, [f"c{rng.randrange(t)}"] if t else []) for t in range(60)]  # a tree
    calls += [(4, 50 - t, f"c{t}", "add", ok, [f"c{rng.randrange(t)}" for _ in range(rng.randrange(4))] if t else []) for t in range(50)]
    calls += [(5, t, f"c{t}", "add", ok, [f"c{rng.randrange(30)}"] * (t % 3 > 0)) for t in range(30)]  # with cycles
    calls += [(6, t, f"c{t}", "add", ok, [f"c{(t + 1) % 3}"]) for t in range(3)] + [(6, 9, "behind", "add", ok, ["c1", "free"]), (6, 8, "free", "add", ok, None)]
    calls += [(7, t, f"c{t}", "add", ok, [f"c{t - 1}", f"c{t - 2}"] if t % 2 == 0 and t else [f"c{t - 1}"] if t else []) for t in range(25)]
    calls += [(8, t, f"c{t}", "add", ok, [f"c{i}" for i in range(t)]) for t in range(30)]  # all before
    got, want = run(spark, calls, []), plain_depths(calls)
    assert {k: r.depth for k, r in got.items()} == want and any(d is None for d in want.values())
    ordered = {c for c in range(1, 9)} - {c[0] for c in calls for d in c[5] or [] for e in calls if (e[0], e[2]) == (c[0], d) and e[1] >= c[1]}
    assert ordered >= {1, 2, 3, 7, 8} and all(r.level == (0 if k[0] in ordered else r.depth) for k, r in got.items())
    assert all((r.status == "cyclic") == (want[k] is None) for k, r in got.items())


def test_calls_without_turn_are_ordered(spark):
    ok = '{"a":1,"b":1}'
    got = run(spark, [(1, None, "a", "add", ok, []), (1, 2, "b", "add", ok, ["a", "zz"]), (1, 1, "c", "add", ok, ["b"]),
                      (2, None, "x", "add", ok, ["y"]), (2, 3, "y", "add", ok, ["x"])], [])
    assert {k[1]: (r.level, r.depth, r.errors) for k, r in got.items() if k[0] == 1} == {"a": (0, 0, []), "b": (1, 1, ["after:zz"]), "c": (2, 2, [])}
    assert {k[1]: (r.level, r.depth, r.status) for k, r in got.items() if k[0] == 2} == {"x": (None, None, "cyclic"), "y": (None, None, "cyclic")}


def test_query_gives_depths(spark):
    rows = {(r.conv_id, r.call_id): r for r in op3_chat_tool_calls(spark, SF).collect()}
    calls = [(t.conv_id, t.turn, f"call_{t.conv_id}_{t.turn}", None, None, [f"call_{t.conv_id}_{t.turn - 2}"] if t.turn >= 2 else [])
             for t in spark.read.parquet(f"{SF}/conversations.parquet").collect() if t.role == "user"]
    want = plain_depths(calls)
    assert {k: r.depth for k, r in rows.items() if r.n_calls} == want and max(want.values()) > 1


def test_empty(spark):
    assert run(spark, [], []) == {}
    df = spark.createDataFrame([(None, None, None, None, 1), (1, 0, "user", None, 1), (1, 0, "user", None, 1)], "conv_id long, turn long, role string, text string, CONTENT int")
    rows = chat.link_conversations(df).collect()
    assert [(r.status, r.n_calls, r.valid, r.errors) for r in rows] == [("missing_result", 2, False, ["minimum:limit", "missing:query"])]


def test_query_equals_plain_python(spark):
    rows = {(r.conv_id, r.call_id): r for r in op3_chat_tool_calls(spark, SF).collect()}
    turns = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    calls, results = {}, {}
    for t in turns:
        if t.role == "user":
            n, short = len(t.text.split()), len(t.text) < 160
            body = {"limit": n, "query": t.text} if short else {"max_words": n, "prompt": t.text, "style": "list" if "\n" in t.text else "plain"}
            calls[t.conv_id, f"call_{t.conv_id}_{t.turn}"] = (t, "lookup" if short else "reply", body)
        elif t.role == "assistant":
            results[t.conv_id, f"call_{t.conv_id}_{t.turn - 1}"] = t
    assert set(rows) == set(calls) | set(results)
    for key, r in rows.items():
        content = results[key].text if key in results else None
        if key not in calls:
            assert r.status == "orphan_result"
            continue
        t, name, body = calls[key]
        errors = []
        if name == "lookup":
            errors += ["maximum:limit"] * (body["limit"] > 50) + ["minimum:limit"] * (body["limit"] < 1)
        else:
            errors += ["length:prompt"] * (len(t.text) > 2000) + ["minimum:max_words"] * (body["max_words"] < 1)
        before = f"call_{t.conv_id}_{t.turn - 2}"
        errors = sorted(errors) + [f"after:{before}"] * (t.turn >= 2 and (t.conv_id, before) not in calls)
        assert (r.status, r.level, r.errors) == ("linked" if key in results else "missing_result", 0, errors)
        message = {"arguments": body, **({"content": content} if content is not None else {}), "id": key[1], "name": name}
        assert r.message == json.dumps(message, ensure_ascii=False, separators=(",", ":"))
