import json
import random
from collections import defaultdict

import pytest

from tripaudit.llm import tool_calls as tc
from tripaudit.llm.queries import REGISTRY

CALLS = "conv_id long, call_id string, turn long, name string, arguments string"
RESULTS = "conv_id long, call_id string, turn long, content string"
TOOLS = {"add": {"type": "object", "properties": {"a": {"type": "number"}, "b": {"type": "number", "minimum": 0}}, "required": ["a"], "additionalProperties": False}}


def frames(spark, calls, results):
    return spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    asked, given = defaultdict(list), defaultdict(list)
    for r in rows:
        if r.role == "user":
            asked[r.conv_id, r.turn].append(r.text or "")
        elif r.role == "assistant":
            given[r.conv_id, r.turn - 1].append(r.text or "")
    want = {}
    for key in asked.keys() | given.keys():
        out = {"call_id": f"turn-{key[1]}"}
        if key in asked:
            text = min(asked[key])
            status = "invalid" if not text else "ok" if key in given else "no_result"
            out |= {"name": "reply", "arguments": {"text": text, "turn": key[1]}}
        else:
            status = "no_call"
        if key in given:
            out["result"] = min(given[key])
        want[key[0], out["call_id"]] = json.dumps(out | {"status": status}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    got = {(r.conv_id, r.call_id): r.json for r in REGISTRY["op3_tool_calls"](spark, sf).collect()}
    assert got == want


def test_statuses(spark):
    calls = [
        (1, "a", 1, "add", '{"a": 1, "b": 2.0}'), (1, "b", 2, "add", '{"b": -1, "c": 1}'), (1, "c", 3, "none", "{}"), (1, "d", 4, "add", '{"a":1}'),
        (1, "e", 9, "add", '{"a":1}'), (2, "a", 1, "add", None), (2, "b", 1, None, "not json"), (2, "x", 5, "add", '{"a":1}'), (2, "x", 5, "add", '{"a":1}'),
        (2, "x", 4, "add", '{"a":7}'),
    ]
    results = [(1, "a", 2, '{"z":1,"y":[1.50]}'), (1, "e", 3, "r"), (3, "a", 1, "orphan"), (2, "x", 6, "late"), (2, "x", 5, "soon"), (1, "b", 3, "q")]
    got = {(r.conv_id, r.call_id): r for r in tc.link(*frames(spark, calls, results), TOOLS).collect()}
    status = {k: r.status for k, r in got.items()}
    assert status == {
        (1, "a"): "ok", (1, "b"): "invalid", (1, "c"): "invalid", (1, "d"): "no_result", (1, "e"): "early_result", (2, "a"): "invalid",
        (2, "b"): "invalid", (2, "x"): "ok", (3, "a"): "no_call",
    }
    assert got[1, "b"].errors == "$.a: missing; $.b: range; $.c: unknown" and got[1, "c"].errors == "$: no such tool"
    assert got[1, "a"].json == '{"arguments":{"a":1,"b":2},"call_id":"a","name":"add","result":{"y":[1.5],"z":1},"status":"ok"}'
    x = got[2, "x"]
    assert (x.n_calls, x.n_results, x.call_turn, x.result_turn) == (3, 2, 4, 5) and '"a":7' in x.json and "soon" in x.json


def test_levels_against_plain_peeling(spark):
    rng = random.Random(8)
    calls, refs = [], {}
    for conv in range(6):
        for i in range(25):
            own = [f"k{rng.randrange(i)}" for _ in range(rng.randrange(3))] if i else []
            if conv == 5 and i in (10, 20):
                own.append(f"k{30 - i}")
            refs[conv, f"k{i}"] = set(own)
            calls.append((conv, f"k{i}", i, "add", json.dumps({"a": [{"$result": x} for x in own], "n": "$result"})))
    level = {}
    for _ in range(200):
        for (conv, k), own in refs.items():
            if all((conv, x) in level for x in own):
                level[conv, k] = 1 + max(level[conv, x] for x in own) if own else 0
    got = tc.link(*frames(spark, calls, []), TOOLS).collect()
    assert {(r.conv_id, r.call_id): r.level for r in got} == {k: level.get(k) for k in refs}
    assert any(r.status == "cycle" for r in got) and all((r.status == "cycle") == (r.level is None) for r in got)


@pytest.mark.parametrize(
    "value, text",
    [
        ({"b": 1, "a": [True, None, "é\n"]}, '{"a":[true,null,"é\\n"],"b":1}'), (1.0, "1"), (-0.5, "-0.5"), (1e21, "1e+21"), (1e-7, "1e-7"),
        (0.000001, "0.000001"), (1.5e-5, "0.000015"), (123456789012345680000.0, "123456789012345680000"), ({"": 1, "😀": 2}, '{"😀":2,"":1}'),
    ],
)
def test_canonical(value, text):
    assert tc.canonical(value) == text and (json.loads(text) == value or float(text) == value)


def test_explicit_calls_nulls_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, level string, json int"
    call = json.dumps({"content": "", "tool_calls": [{"id": "q", "name": "add", "arguments": {"a": 1}}, {"id": None, "name": None}]})
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", call), (1, 2, "tool", '{"tool_call_id": "q", "content": "3"}'), (1, 3, "assistant", "{broken"),
        (None, 1, "user", "x"), (1, None, "user", "x"), (1, 5, None, None), (2, 0, "user", "word " * 20000), (2, 0, "user", "word " * 20000),
    ]
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], schema)
    got = {(r.conv_id, r.call_id): r for r in tc.link(*tc.calls_and_results(frame), TOOLS | tc.SCHEMAS).collect()}
    assert {k: r.status for k, r in got.items()} == {
        (1, "turn-0"): "invalid", (1, "q"): "ok", (1, ""): "invalid", (1, "turn-2"): "no_call", (2, "turn-0"): "no_result",
    }
    assert got[1, "q"].json.endswith('"name":"add","result":3,"status":"ok"}') and got[2, "turn-0"].n_calls == 2
    assert tc.link(*tc.calls_and_results(spark.createDataFrame([], schema))).collect() == []
