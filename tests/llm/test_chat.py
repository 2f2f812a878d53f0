import json

import pytest
from pyspark.sql import functions as F

from tideline.llm import chat

MESSAGES = "conv_id long, turn long, role string, text string, place string"
SCHEMA = {
    "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 12}, "turn": {"type": "integer", "minimum": 0}},
    "required": ["text", "turn"],
    "additionalProperties": False,
}


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], MESSAGES)
    return chat.format_chat(df, {"respond": SCHEMA}).collect()


def test_links_order_and_json(spark):
    rows = [
        (1, 0, "system", 'be "brief"\n'), (1, 1, "user", "hi é"), (1, 2, "assistant", "yes\\no\t"), (1, 3, "user", "x" * 13),
        (2, 0, "assistant", "early"), (2, 1, "user", None), (2, 2, "assistant", None), (2, 3, None, "who"),
        (3, 0, "user", ""), (3, 1, "assistant", "a"), (3, 1, "assistant", "b"), (4, 0, "user", "q"), (4, 0, "user", "q"), (4, 1, "assistant", "r"),
    ]
    got = sorted(run(spark, rows), key=lambda r: (r["conv_id"], r["place"], r["json"]))
    assert len(got) == len(rows)
    facts = [(r["conv_id"], r["place"], r["kind"], r["status"], r["violations"]) for r in got]
    assert facts == [
        (1, 0, "message", None, None), (1, 2, "call", "linked", ""), (1, 5, "result", "linked", None),
        (1, 6, "call", "unanswered", "text: too long"),
        (2, 1, "result", "orphan", None), (2, 2, "call", "linked", "text: missing"), (2, 5, "result", "linked", None), (2, 6, "message", None, None),
        (3, 0, "call", "linked", "text: too short"), (3, 3, "result", "repeated", None), (3, 3, "result", "repeated", None),
        (4, 0, "call", "repeated", ""), (4, 0, "call", "repeated", ""), (4, 3, "result", "linked", None),
    ]
    for r in got:
        value = json.loads(r["json"])
        assert json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]
        if r["kind"] == "call":
            assert value["tool_call"]["id"] == r["call_id"] and value["tool_call"]["arguments"]["turn"] == r["turn"]
        elif r["status"] in ("linked", "repeated"):
            assert value["tool_call_id"] == r["call_id"]
    assert json.loads(got[0]["json"])["content"] == 'be "brief"\n'


def test_results_never_come_before_their_calls(spark):
    calls = spark.createDataFrame([(1, "a", 9), (1, "b", 2), (2, None, 1)], "conv_id long, call_id string, turn long")
    results = spark.createDataFrame([(1, "a", 3), (1, "b", 4), (1, "c", 5), (2, None, 2)], "conv_id long, call_id string, turn long")
    made, answers = chat.link(calls, results)
    place = {r["call_id"]: r["place"] for r in made.collect()}
    after = {r["call_id"]: (r["place"], r["status"]) for r in answers.collect()}
    assert after["a"][0] > place["a"] and after["b"][0] > place["b"]
    assert after["c"][1] == "orphan" and after[None][1] == "orphan"


@pytest.mark.parametrize(
    "arguments, want",
    [
        ('{"text":"a","turn":1}', []),
        ('{"turn":1.5,"text":"a"}', ["turn: not integer"]),
        ('{"turn":"1","text":2}', ["text: not string", "turn: not integer"]),
        ('{"text":"a","turn":-1,"z":1,"b":null}', ["turn: too small", "unknown: b,z"]),
        ('{"text":null,"turn":0}', ["text: not string"]),
        ("{}", ["text: missing", "turn: missing"]),
        ("[1]", ["not an object", "text: missing", "turn: missing"]),
        ("{broken", ["not an object", "text: missing", "turn: missing"]),
        (None, ["not an object", "text: missing", "turn: missing"]),
    ],
)
def test_violations(spark, arguments, want):
    df = spark.createDataFrame([(arguments,)], "a string").select(chat.violations(F.col("a"), SCHEMA).alias("v"))
    assert df.first()["v"] == want


def test_unknown_functions(spark):
    df = spark.createDataFrame([("other", "{}"), (None, "{}")], "name string, arguments string")
    assert [r["violations"] for r in chat.check(df, {"respond": SCHEMA}).collect()] == [["unknown function"]] * 2


def test_canonical_json(spark):
    rows = [('{ "b" : [1, {"d":null,"c":true}], "a":"\\u00e9" }', '{"a":"é","b":[1,{"c":true,"d":null}]}'), ("{x", None), (None, None)]
    got = spark.createDataFrame([(a,) for a, _ in rows], "j string").select(chat.canonical(F.col("j")).alias("c")).collect()
    assert [r["c"] for r in got] == [b for _, b in rows]


def test_long_conversation_long_text_and_empty_table(spark):
    rows = [(7, t, ["user", "assistant"][t % 2], "y" * (90_000 if t == 4 else 3)) for t in range(600)]
    got = run(spark, rows)
    assert sorted(r["place"] for r in got) == sorted(2 * t + t % 2 for t in range(600))
    assert {r["status"] for r in got} == {"linked"}
    assert run(spark, []) == []


def test_missing_conversation_and_turn(spark):
    got = run(spark, [(None, 1, "user", "a"), (1, None, "assistant", "b"), (None, None, None, None)])
    assert sorted((r["kind"], r["status"]) for r in got if r["kind"] != "message") == [("call", "unanswered"), ("result", "orphan")]
    assert len(got) == 3 and all(r["json"] for r in got)
