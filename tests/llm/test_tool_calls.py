"""Linking, order, validation and canonical form of tool calls."""

import json
import re
from collections import Counter

import pytest

from meterline.llm import tool_calls
from meterline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, tool_calls array<struct<id:string,name:string,arguments:string>>, tool_call_id string, stage string"


def events(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return [r.asDict() for r in tool_calls.link(df).collect()]


def call(conv, turn, *entries):
    return (conv, turn, "assistant", "", list(entries), None)


def result(conv, turn, call_id, text="ok"):
    return (conv, turn, "tool", text, [], call_id)


def test_linking_and_order(spark):
    good = '{"limit": 3, "query": "q"}'
    rows = [
        call(1, 0, ("a", "search", good), ("b", "search", '{"query": "$ref:a", "limit": 2}')), call(1, 2, ("a", "lookup", good), (None, "search", good)),
        result(1, 1, "a"), result(1, 1, "b", 'a "quote"\n'), result(1, 3, "a"), result(1, 0, "b", "soon"), result(1, 1, "z"), result(1, 5, None), result(1, 1, "a"),
        call(2, 0, ("x", "search", '{"query": "$ref:y", "limit": 1}'), ("y", "search", '{"query": "$ref:x", "limit": 1}'), ("w", "search", '{"query": "$ref:y", "limit": 1}')),
        call(None, None, ("n", "search", good)), result(None, 4, "n"), (3, 1, "user", None, None, None), (4, 0, None, "t", [], None),
    ]
    got = {(e["conv_id"], e["kind"], e["call_id"], e["turn"], e["pos"], e["status"]): e for e in events(spark, rows)}
    status = sorted(got, key=str)
    assert status == sorted([
        (1, "call", "a", 0, 0, "answered"), (1, "call", "b", 0, 1, "answered"), (1, "call", "a", 2, 0, "duplicate"), (1, "call", None, 2, 1, "no_id"),
        (1, "result", "a", 1, 0, "linked"), (1, "result", "b", 1, 0, "linked"), (1, "result", "a", 3, 0, "extra"), (1, "result", "b", 0, 0, "early"),
        (1, "result", "z", 1, 0, "orphan"), (1, "result", None, 5, 0, "orphan"), (2, "call", "x", 0, 0, "cycle"), (2, "call", "y", 0, 1, "cycle"), (2, "call", "w", 0, 2, "cycle"),
        (None, "call", "n", None, 0, "answered"), (None, "result", "n", 4, 0, "linked"),
    ], key=str)
    stage = {k[:4]: e["stage"] for k, e in got.items() if e["stage"] is not None}
    assert stage == {(1, "call", "a", 0): 0, (1, "result", "a", 1): 1, (1, "call", "b", 0): 2, (1, "result", "b", 1): 3, (None, "call", "n", None): 0, (None, "result", "n", 4): 1}
    assert got[1, "result", "a", 1, 0, "linked"]["copies"] == 2
    assert json.loads(got[1, "result", "b", 1, 0, "linked"]["canonical"]) == {"content": 'a "quote"\n', "id": "b", "type": "result"}


def test_validation_and_canonical_json(spark):
    cases = {
        '{"limit": 3, "query": "é \\u0041"}': [], '{"query": "x"}': ["missing:limit"], '{"query": 1, "limit": 2.5}': ["type:limit", "type:query"],
        '{"query": null, "limit": "$ref:a"}': ["type:query"], '{"query": "x", "limit": 1, "b": {"z": 1, "a": [true]}}': ["extra:b"], "[1]": ["not_object"], "{": ["not_json"], None: ["not_json"], "": ["not_json"],
    }
    rows = [call(1, i, (f"i{i}", "search", text)) for i, text in enumerate(cases)] + [call(1, 99, ("u", "none", "{}"), ("v", None, "{}"))]
    got = {e["call_id"]: e for e in events(spark, rows)}
    for i, (text, errors) in enumerate(cases.items()):
        e = got[f"i{i}"]
        assert e["errors"] == errors, text
        try:
            value = json.loads(text)
        except (TypeError, ValueError):
            value = text
        want = json.dumps({"arguments": value, "id": f"i{i}", "name": "search", "type": "call"}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert e["canonical"] == want
    assert got["u"]["errors"] == got["v"]["errors"] == ["unknown_tool"]


def test_no_messages(spark):
    assert events(spark, []) == []


def compact(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def parsed(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return text


def direct(messages):
    """The events of messages that have identifiers and turns, message by message."""
    calls, results = Counter(), Counter()
    for m in messages:
        for pos, c in enumerate(m.tool_calls):
            calls[m.conv_id, c.id, m.turn, pos, c.name, c.arguments] += 1
        if m.role == "tool":
            results[m.conv_id, m.tool_call_id, m.turn, m.text] += 1
    holder, first, depth = {}, {}, {}
    for conv, call_id, *at in sorted(calls):
        holder.setdefault((conv, call_id), at)
    for conv, call_id, turn, text in sorted(results, key=lambda r: (*r[:3], r[3] or "")):
        if (conv, call_id) in holder and turn > holder[conv, call_id][0]:
            first.setdefault((conv, call_id), (turn, text or ""))
    refs = {(conv, i): [(conv, r) for r in re.findall(tool_calls.REFERENCE, at[3]) if (conv, r) in holder] for (conv, i), at in holder.items()}
    found = True
    while found:
        found = {k: max([depth[r] + 1 for r in of], default=0) for k, of in refs.items() if k not in depth and all(r in depth for r in of)}
        depth |= found
    out = []
    for (conv, call_id, turn, pos, name, arguments), copies in calls.items():
        key, value = (conv, call_id), parsed(arguments)
        holds = holder[key] == [turn, pos, name, arguments]
        status = "duplicate" if not holds else "cycle" if key not in depth else "answered" if key in first else "unanswered"
        if not isinstance(value, dict):
            errors = ["not_json"]
        elif name not in tool_calls.SCHEMAS:
            errors = ["unknown_tool"]
        else:
            fields = tool_calls.SCHEMAS[name]
            errors = [f"extra:{k}" for k in value if k not in fields] + [f"missing:{k}" for k, (_, needed) in fields.items() if needed and k not in value]
            errors += [f"type:{k}" for k, (kind, _) in fields.items() if k in value and not str(value[k]).startswith("$ref:") and isinstance(value[k], str) != (kind == "string")]
        stage = 2 * depth[key] if holds and key in depth else None
        out.append((conv, stage, turn, pos, "call", call_id, name, status, ",".join(sorted(errors)), copies, compact({"type": "call", "id": call_id, "name": name, "arguments": value})))
    for (conv, call_id, turn, text), copies in results.items():
        key = (conv, call_id)
        linked = first.get(key) == (turn, text or "")
        status = "orphan" if key not in holder else "early" if turn <= holder[key][0] else "linked" if linked else "extra"
        stage = 2 * depth[key] + 1 if linked and key in depth else None
        out.append((conv, stage, turn, 0, "result", call_id, None, status, "", copies, compact({"type": "result", "id": call_id, "content": text})))
    return out


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_returns_whole_events(spark, scale):
    """Results have their canonical texts, and events their place in the message."""
    folder = f"/root/testdata/{scale}"
    got = QUERIES["op4_tool_call_events"](spark, folder)
    assert got.columns == ["conv_id", "stage", "turn", "pos", "kind", "call_id", "name", "status", "errors", "copies", "canonical"]
    want = direct(tool_calls.table_messages(spark.read.parquet(f"{folder}/conversations.parquet")).collect())
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == sorted(want, key=repr)
    assert any(r[4] == "result" for r in rows) and all(r[-1] is not None for r in rows)


def test_text_ids_null_turns_and_repeated_keys(spark):
    good = '{"limit": 3, "query": "q"}'
    rows = [
        ("x-1", None, "assistant", "", [("a", "search", good)], None), ("x-1", 0, "tool", "ok", [], "a"), ("-", 1, "assistant", "", [("a", "search", good)], None),
        (None, 2, "assistant", "", [("a", "search", '{"limit": 3, "limit": 4, "query": "q"}')], None), ("", -1, "tool", "ok", [], "a"), (None, 3, "tool", "ok", [], "a"),
    ]
    df = spark.createDataFrame(rows, SCHEMA.replace("conv_id long", "conv_id string").replace(", stage string", ""))
    got = {(r.conv_id, r.turn, r.kind): (r.status, r.errors) for r in tool_calls.link(df).collect()}
    assert got == {
        ("x-1", None, "call"): ("answered", []), ("x-1", 0, "result"): ("linked", []), ("-", 1, "call"): ("unanswered", []),
        (None, 2, "call"): ("answered", ["not_json"]), (None, 3, "result"): ("linked", []), ("", -1, "result"): ("orphan", []),
    }
