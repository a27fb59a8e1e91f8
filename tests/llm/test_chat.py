import json
import random

import pytest

from pulsevault.llm import chat as C

CALLS = "conv_id long, call_id string, position long, name string, arguments string, after array<string>"
RESULTS = "conv_id long, call_id string, position long, content string"
SCHEMA = {"add": {"properties": {"a": {"type": "integer"}, "b": {"type": "number"}}, "required": ["a"]}}


def test_links_order_and_validation(spark):
    calls = [
        (1, "x", 1, "add", '{"b": 1.5, "a": 1}', []), (1, "y", 2, "add", '{"a": 2}', ["x"]), (1, "z", 3, "add", '{"a": 3}', ["y", "x", "x"]), (1, "x", 9, "add", '{"a": 99}', []),
        (2, "x", 1, "add", '{"b": 1}', ["gone"]), (2, "p", 2, "add", '{"a": true}', ["q"]), (2, "q", 3, "sub", "{", ["p"]), (3, None, 1, "add", None, None), (None, "n", 1, "add", '{"a": 1, "é": 2}', None),
    ]
    results = [(1, "x", 2, "r1"), (1, "x", 1, "r0"), (1, "nobody", 1, "lost"), (2, "q", 4, None)]
    found = C.linked_calls(spark.createDataFrame(calls, CALLS).selectExpr("*", "'clash' AS level"), spark.createDataFrame(results, RESULTS), SCHEMA).collect()
    got = {(r.conv_id, r.call_id): r for r in found}
    assert len(found) == 8
    assert [got[(1, k)].level for k in "xyz"] == [0, 1, 2] and all(got[(1, k)].valid for k in "xyz")
    assert got[(1, "x")].message == '{"call":{"arguments":{"a":1,"b":1.5},"id":"x","name":"add","type":"function"},"conversation":1,"result":{"content":"r0","id":"x"}}'
    assert json.loads(got[(1, "y")].message)["result"] is None
    assert got[(2, "x")].problem == "a is missing; refers to an unknown call"
    assert got[(2, "p")].level is None and "on a cycle" in got[(2, "p")].problem and "a is no integer" in got[(2, "p")].problem
    assert got[(2, "q")].problem.startswith("unknown tool") and not got[(3, None)].valid
    assert got[(None, "n")].problem == "é is unknown; refers to an unknown call"


def test_empty(spark):
    assert C.linked_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMA).count() == 0


def levels_of(needs):
    """level of every call of {call: the calls that it refers to}, None where it is on a cycle or waits for one."""
    level, left = {}, dict(needs)
    while True:
        ready = {c: 1 + max([level[a] for a in after], default=-1) for c, after in left.items() if all(a in level for a in after)}
        if not ready:
            return level | dict.fromkeys(left)
        level |= ready
        left = {c: a for c, a in left.items() if c not in ready}


@pytest.mark.parametrize("seed", range(3))
def test_levels_of_any_graph(spark, seed):
    rng, needs = random.Random(seed), {}
    for conv in range(12):
        names = [f"c{i}" for i in range(rng.randrange(1, 40))]
        for i, name in enumerate(names):
            before = names[:i] if rng.random() < 0.97 or conv % 3 else names  # some refer forward
            needs[conv, name] = sorted(set(rng.sample(before, min(len(before), rng.choice([0, 1, 1, 1, 1, 2, 3])))))
    needs |= {(99, f"c{i}"): [f"c{i - 1}"] * (i > 0) for i in range(300)}  # one long chain
    needs |= {(98, "a"): ["b"], (98, "b"): ["a"], (98, "c"): ["a"], (98, "d"): ["c"], (98, "e"): [], (98, "f"): ["d", "e"], (98, "self"): ["self"], (98, "g"): ["e", "e2"], (98, "e2"): ["e"]}
    want = levels_of({k: [(k[0], a) for a in v] for k, v in needs.items()})
    frame = spark.createDataFrame([(c, n, 0, "add", '{"a":1}', v) for (c, n), v in needs.items()], CALLS)
    got = {(r.conv_id, r.call_id): r.level for r in C.linked_calls(frame, spark.createDataFrame([], RESULTS), SCHEMA).collect()}
    assert got == want and want[99, "c299"] == 299 and want[98, "f"] is None and want[98, "g"] == 2


def brute(rows):
    """call_id: level, what is wrong, result of the user turns."""
    users, answers, closing = {}, {}, set()
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        if role == "user":
            users.setdefault(c, {})[t] = text
        elif role == "assistant" and any(u < t for u in users.get(c, ())):
            answers.setdefault((c, max(u for u in users[c] if u < t)), text)
        elif role == "system" and "\n" in text:
            closing.add(c)
    out = {}
    for c, turns in users.items():
        for i, (t, text) in enumerate(sorted(turns.items())):
            wrong = ["unknown tool"] if "\n" not in text and not text.isascii() else ["limit is missing"] if "\n" in text and len(text) < 300 else []
            out[f"{c}:{t}"] = (None if c in closing else i, "; ".join(wrong + ["is on a cycle"] * (c in closing)) or None, answers.get((c, t)))
    return out


def test_every_turn_is_kept(spark, sf_dir):
    from pulsevault.llm.queries import op6_tool_calls

    sf_dir = sf_dir.replace("0.001", "0.01")
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = op6_tool_calls(spark, sf_dir).collect()
    want = brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    calls = {r.call_id: (r.level, r.problem, (json.loads(r.message)["result"] or {}).get("content")) for r in got if r.kind == "call"}
    assert calls == want
    assert {None, "unknown tool", "limit is missing", "is on a cycle"} <= {p for _, p, _ in want.values()}
    inside = sum(json.loads(r.message)["result"] is not None for r in got if r.kind == "call")
    assert len(got) + inside == df.count()
    assert sum(r.kind == "message" for r in got) == df.where("role = 'system'").count() > 0


def test_long_and_hot_conversations(spark):
    """One conversation holds most rows; a very long text and columns with clashing names do no harm."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(3000)] + [(i, 0, "user", "word " * 40_000) for i in (2, 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("level", "last", "refers", "copy", "n", "call_id"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    got = {r.call_id: r for r in C.every_turn(df).collect()}
    assert len(got) == 1502 and all(got[f"1:{t}"].level == t // 2 and got[f"1:{t}"].valid for t in range(0, 3000, 2))
    assert got["2:0"].valid and json.loads(got["2:0"].message)["call"]["arguments"]["prompt"] == "word " * 40_000


def test_odd_turns_are_kept(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, 1, "user", None), (1, 2, "tool", "t"), (1, 3, "assistant", "r"), (1, 4, "assistant", "later"), (1, 4, "assistant", "later"),
        (1, 5000, "assistant", "far"), (1, 5001, "user", "u"), (1, 9000, "assistant", "v"), (2, 0, "assistant", "lost"), (2, 1, None, "z"), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, None, "system", None), (3, None, "user", "w"),
    ]
    got = C.every_turn(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    found = []
    for r in got:
        m = json.loads(r.message)
        if r.kind == "call":
            args = m["call"]["arguments"]
            found.append((r.conv_id, args.get("turn"), "user", args.get("prompt")))
            if m["result"]:
                found.append((r.conv_id, {"r": 3, "v": 9000}[m["result"]["content"]], "assistant", m["result"]["content"]))
        else:
            found.append((r.conv_id, r.position, m[r.kind]["role"], m[r.kind]["content"]))
    assert sorted(found, key=repr) == sorted(rows, key=repr)
    calls = [r.call_id for r in got if r.kind == "call" and r.call_id]
    assert len(set(calls)) == len(calls)
    kept = {r.call_id: json.loads(r.message) for r in got if r.kind == "call"}
    assert (kept["1:1"]["call"]["arguments"]["prompt"], kept["1:1"]["result"]["content"], kept["1:5001"]["result"]["content"]) == ("a", "r", "v")
    spare = sorted((r.position, r.call_id or "", r.problem) for r in got if r.kind == "result")
    assert spare == [(0, "", "has no call"), (1, "", "has no call"), (4, "1:1", "call has another result"), (4, "1:1", "call has another result"), (5000, "1:1", "call has another result")]
    assert kept["1:5001"]["call"]["arguments"]["after"] == ["1:1"] and [r.level for r in got if r.call_id == "1:5001"] == [1]
    assert not any(r.valid for r in got if r.kind == "result") and all(r.valid for r in got if r.kind == "message" and r.conv_id == 1)
    assert C.every_turn(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
