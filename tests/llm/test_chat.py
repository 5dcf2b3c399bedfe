"""Chat: links, levels, argument checks and canonical JSON against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tierflow.llm import chat

EVENTS = "conversation long, place long, role string, kind string, id string, parent string, name string, content string, json string, level int"
TOOLS = "name string, parameters array<struct<name: string, type: string, required: boolean>>, place int"
PARAMS = {"add": [("a", "integer", True), ("b", "number", True), ("note", "string", False)], "go": [("o", "object", False), ("l", "array", False), ("f", "boolean", False), ("z", "null", False)]}


def tools(spark):
    return spark.createDataFrame([(n, p, 1) for n, p in PARAMS.items()], TOOLS)


def kind_of(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    return {str: "string", int: "integer", float: "number", list: "array", dict: "object"}[type(v)]


def errors(name, text):
    if name not in PARAMS:
        return ["tool"]
    try:
        given = json.loads(text)
        assert isinstance(given, dict)
    except (TypeError, ValueError, AssertionError):
        return ["arguments"]
    out = [f"missing:{n}" for n, _, r in PARAMS[name] if r and n not in given]
    out += [f"type:{n}" for n, t, _ in PARAMS[name] if n in given and kind_of(given[n]) != t and not (t == "number" and kind_of(given[n]) == "integer")]
    out += [f"unknown:{k}" for k in given if k not in {n for n, _, _ in PARAMS[name]}]
    return sorted(out)


def canon(v):
    return json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


@pytest.mark.parametrize(
    "name,text",
    [
        ("add", '{"b": 2.5, "a": 1}'),
        ("add", '{"b": 2, "a": 1.5, "note": 3}'),
        ("add", '{"a": "1", "x": {"q": [1, {"z": 1, "y": "é\\n\\""}]}}'),
        ("add", "[1]"),
        ("add", "no"),
        ("add", None),
        ("other", "{}"),
        ("go", '{"o": {"b": 1, "a": 2}, "l": [], "f": true, "z": null}'),
        ("go", '{"o": [], "l": {}, "f": 0, "z": 0}'),
        ("go", "{}"),
    ],
)
def test_arguments(spark, name, text):
    df = spark.createDataFrame([(1, 1, "assistant", "call", "c", None, name, text, "", 0)], EVENTS)
    row = chat.link(df, tools(spark)).first()
    assert row.errors == errors(name, text)
    try:
        want = canon({"arguments": json.loads(text), "call_id": "c", "name": name, "type": "call"})
    except (TypeError, ValueError):
        want = canon({"arguments": text, "call_id": "c", "name": name, "type": "call"})
    assert row.json == want


def test_links_and_levels(spark):
    rng = random.Random(1)
    rows = [(1, 0, "system", "message", None, None, None, 'say "hi"\n', "", 0)]
    for i in range(40):  # a forest with a long chain
        rows.append((1, i, "assistant", "call", f"c{i}", f"c{i - 1}" if i % 13 else rng.choice([None, "gone"]), "go", "{}", "", 0))
        if i % 3:
            rows.append((1, i, "tool", "result", f"c{i}", None, None, f"r{i}", "", 0))
    rows += [(2, i, "assistant", "call", f"c{i}", f"c{(i + 1) % 3}", "go", "{}", "", 0) for i in range(3)] + [(2, 9, "assistant", "call", "c9", "c1", "go", "{}", "", 0)]
    rows += [(3, 1, "tool", "result", "x", None, None, None, "", 0), (3, 2, "assistant", "call", "y", None, "go", "{}", "", 0), (3, 2, "assistant", "call", "y", None, "go", "{}", "", 0)]
    rows += [(None, 1, "assistant", "call", "c1", None, "go", "{}", "", 0), (4, None, "assistant", "call", None, None, "go", "{}", "", 0), (5, 1, None, "message", None, None, None, None, "", 0)]
    got = chat.link(spark.createDataFrame(rows, EVENTS), tools(spark)).collect()
    assert len(got) == len(rows)
    one = {(r.id, r.kind): r for r in got if r.conversation == 1}
    for i in range(40):
        assert one[f"c{i}", "call"].level == 2 * (i % 13)
        assert one[f"c{i}", "call"].link == ("linked" if i % 3 else "no result")
        if i % 3:
            assert (one[f"c{i}", "result"].level, one[f"c{i}", "result"].link) == (2 * (i % 13) + 1, "linked")
    assert one[None, "message"].json == '{"content":"say \\"hi\\"\\n","role":"system","type":"message"}'
    assert all(r.level is None for r in got if r.conversation == 2)
    three = [(r.id, r.link, r.level) for r in got if r.conversation == 3]
    assert sorted(map(repr, three)) == sorted(map(repr, [("x", "no call", None), ("y", "repeated", 0), ("y", "repeated", 0)]))
    assert {r.link for r in got if r.conversation is None or r.conversation == 4} == {"no id"}
    assert [r.json for r in got if r.conversation == 5] == ['{"content":null,"role":null,"type":"message"}']


def test_native_plan_and_turns(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").unionByName(spark.createDataFrame([(None, 1, "user", "a"), (9999, None, "user", None), (9998, 0, "user", None), (9998, 1, None, "x")], "conv_id long, turn long, role string, text string"))
    out = chat.link(chat.events_of_turns(turns), chat.reply_tool(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    rows = out.collect()
    assert len(rows) == turns.count()
    for r in rows:
        json.loads(r.json)
    nulls = [r for r in rows if r.conversation == 9998 and r.kind == "call"]
    assert (nulls[0].errors, nulls[0].link) == (["missing:prompt"], "no result")


def test_empty_and_long(spark):
    none = spark.createDataFrame([], EVENTS)
    assert chat.link(none, tools(spark)).count() == 0
    long = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.repeat(F.lit("ab é"), 500_000).alias("text"))
    row = chat.link(chat.events_of_turns(long), chat.reply_tool(spark)).first()
    assert len(row.json) > 2_000_000 and row.errors == []
