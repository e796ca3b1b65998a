import json
from collections import Counter

from tests.conftest import SF_MID
from tidemark.llm import tool_calls as T

SCHEMA = "conv_id long, turn long, role string, text string"
TOOLS = {"add": {"type": "object", "required": ["a", "b"], "additionalProperties": False,
                 "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "number"}, "tags": {"type": "array", "maxItems": 2, "items": {"enum": ["x", "y"]}}}}}


def run(spark, rows, schemas=TOOLS, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for c in ("call_id", "kind", "body", "level", "status"):
            df = df.selectExpr("*", f"'x' as `{c}`")
    return T.link(T.events(df), schemas).collect()


def call(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "after"), c)) for c in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def test_links_orders_and_validates(spark):
    rows = [(1, 0, "assistant", call(("a", "add", {"b": 2.5, "a": 1}, []), ("b", "add", '{"a": -1, "b": "q", "z": 0}', ["a"]))),
            (1, 1, "tool", result("a", {"y": 1, "x": "é"})), (1, 2, "tool", result("b", None)),
            (1, 3, "assistant", call(("c", "none", {}, ["b", "missing"]), ("a", "add", {}, []))),
            (1, 4, "tool", result("zzz", 1)),
            (2, 0, "assistant", call(("p", "add", {"a": 1, "b": 1, "tags": ["x", "q", "y"]}, ["q"]), ("q", "add", "{bad", ["p"]))),
            (2, 0, "tool", result("p", 1)), (None, 3, "assistant", call(("n", "add", {}, []))), (3, None, "tool", None), (3, 0, None, "{not json")]
    for extra in (False, True):
        got = {(r["conv_id"], r["call_id"], r["status"]): r for r in run(spark, rows, extra=extra)}
        assert {k: (r["level"], r["errors"]) for k, r in got.items()} == {
            (1, "a", "linked"): (0, []), (1, "b", "linked"): (1, ["$.a: minimum", "$.b: type", "$.z: additionalProperties"]),
            (1, "c", "unanswered"): (2, ["$: unknown tool"]), (1, "a", "duplicate_call"): (None, ["$.a: required", "$.b: required"]),
            (1, "zzz", "orphan_result"): (None, []), (2, "p", "early_result"): (None, ["$.tags: maxItems", "$.tags[1]: enum"]),
            (2, "q", "unanswered"): (None, ["$: not JSON"]), (None, "n", "unidentified"): (None, ["$.a: required", "$.b: required"])}
        assert got[(1, "a", "linked")]["record"] == (
            '{"arguments":{"a":1,"b":2.5},"id":"a","name":"add","result":{"x":"é","y":1},"status":"linked"}')


def test_long_chain(spark):
    rows = [(1, 0, "assistant", call(*[(f"c{i}", "add", {}, [f"c{i - 1}"] if i else []) for i in range(20)]))]
    assert {r["call_id"]: r["level"] for r in run(spark, rows)} == {f"c{i}": i for i in range(20)}


def test_plain_conversations_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF_MID}/conversations.parquet")
    rows = df.collect()
    users = Counter((r["conv_id"], r["turn"]) for r in rows if r["role"] == "user")
    answers = Counter((r["conv_id"], r["turn"] - 1) for r in rows if r["role"] == "assistant")
    want = Counter()
    for k, n in users.items():
        want["linked"] += answers.get(k, 0)
        want["unanswered"] += answers.get(k, 0) == 0
        want["duplicate_call"] += n - 1
    want["orphan_result"] = sum(n for k, n in answers.items() if k not in users)
    got = T.link(T.events(df)).collect()
    assert +Counter(r["status"] for r in got) == +want
    text = {(r["conv_id"], r["turn"]): r["text"] for r in rows if r["role"] == "user"}
    for r in got:
        made = json.loads(r["record"])
        assert r["record"] == T.canonical(made)
        if r["status"] == "linked":
            assert made["arguments"]["prompt"] == text[(r["conv_id"], r["call_turn"])] and r["level"] == 0 and not r["errors"]


def test_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x" * 200000), (1, 0, "user", None), (2, 0, "system", "s"), (None, None, "user", ""), (4, 0, "user", "")]
    got = Counter((r["status"], tuple(r["errors"])) for r in run(spark, rows, None))
    assert got == {("linked", ("$.prompt: type",)): 1, ("duplicate_call", ("$.prompt: type",)): 1,
                   ("unidentified", ("$.prompt: minLength",)): 1, ("unanswered", ("$.prompt: minLength",)): 1}
    assert run(spark, [(1, 0, "system", "s")]) == []
    assert T.link(T.events(spark.createDataFrame([], SCHEMA))).count() == 0


def test_null_identifiers_and_numbers(spark):
    rows = [(1, 0, "assistant", call((None, "add", {"a": 1, "b": 1}, []), ("None", "add", {"a": 1, "b": 2}, []))),
            (1, 1, "tool", json.dumps({"tool_call_id": None, "content": "lost"})),
            (2, 0, "assistant", call(("n", "add", '{"a": 1, "b": NaN}', []), ("w", "add", {"a": 1.0, "b": 1e2}, []))),
            (3, 0, "user", '{"tool_calls": [{"id": "x", "name": "add", "arguments": {"a": Infinity}}]}'),
            (4, 0, "assistant", call(("o", "add", '{"a": 1, "b": 1e999}', [])))]
    got = {(r["conv_id"], r["call_id"], r["status"]): r for r in run(spark, rows)}
    assert set(got) == {(1, None, "unidentified"), (1, "None", "unanswered"), (1, None, "orphan_result"),
                        (2, "n", "unanswered"), (2, "w", "unanswered"), (3, "turn:0", "unanswered"), (4, "o", "unanswered")}
    assert got[(2, "n", "unanswered")]["errors"] == ["$: not JSON"] == got[(4, "o", "unanswered")]["errors"]
    assert json.loads(got[(2, "w", "unanswered")]["record"])["arguments"] == {"a": 1, "b": 100}
    assert '"arguments":{"a":1,"b":100}' in got[(2, "w", "unanswered")]["record"]
