"""The whole table of chat formatting against a model in plain Python."""

import collections
import json
import zlib

from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
FIELDS = ["conv_id", "turn", "part", "kind", "place", "rank", "link", "status", "json"]


def dumped(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def tool_use(conv, turn, text):
    """The call of a user turn as (id, tool, arguments, status) and its results as (turn, id, content)."""
    h = zlib.crc32(f"{conv}:{turn}".encode())
    call_id = None if h % 13 == 0 else "same" if h % 11 == 0 else f"c{turn}"
    if h % 17 == 0:
        call = ("weather", {"query": text}, "unknown tool")
    elif h % 19 == 0:
        call = ("search", [text], "no object")
    elif h % 7 == 0:
        call = ("search", {"limit": 3}, "missing:query")
    elif h % 3 == 0:
        call = ("search", {"limit": "3", "query": text}, "type:limit")
    elif h % 3 == 1:
        call = ("calculate", {"expression": text}, "ok")
    else:
        call = ("search", {"limit": h % 100, "query": text}, "ok")
    answers = f"lost{turn}" if h % 31 == 0 else call_id
    turns = [] if h % 5 == 0 else [turn * 10 - 5 if h % 23 == 0 else turn * 10 + 2] + [turn * 10 + 3] * (h % 29 == 0)
    return (call_id, *call), [(t, answers, str(h)) for t in turns]


def model(rows):
    out, calls, results = [], [], []
    for conv, turn, role, text in rows:
        out.append((conv, turn * 10, 0, "message", turn * 10, 0, None, None, dumped({"content": text, "role": role})))
        if role == "user":
            call, answers = tool_use(conv, turn, text)
            calls.append((conv, turn * 10 + 1, *call))
            results += [(conv, *a) for a in answers]
    first_call, first_result = {}, {}
    for conv, turn, call_id, *_ in sorted(calls, key=lambda c: c[:2]):
        first_call.setdefault((conv, call_id), turn)
    for conv, turn, call_id, _ in sorted(results, key=lambda r: r[:2]):
        first_result.setdefault((conv, call_id), turn)
    for conv, turn, call_id, tool, arguments, status in calls:
        key = (conv, call_id)
        link = ("unnamed" if call_id is None else "repeated" if first_call[key] != turn else "ok" if key in first_result else "open")
        said = {"function": {"arguments": arguments, "name": tool}, "type": "function", **({"id": call_id} if call_id else {})}
        out.append((conv, turn, 0, "call", turn, 0, link, status, dumped({"call": said, "role": "assistant"})))
    for conv, turn, call_id, content in results:
        key = (conv, call_id)
        known = call_id is not None and key in first_call
        link = ("unnamed" if call_id is None else "repeated" if first_result[key] != turn else "ok" if known else "orphan")
        place = max(turn, first_call[key]) if known else turn
        said = {"content": content, "role": "tool", **({"tool_call_id": call_id} if call_id else {})}
        out.append((conv, turn, 0, "result", place, 1, link, None, dumped(said)))
    return out


def test_op6_equals_the_model(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert all(None not in r for r in rows)
    got = [tuple(r[f] for f in FIELDS) for r in QUERIES["op6_chat_format"](spark, SF).collect()]
    want = model(rows)
    assert collections.Counter(got) == collections.Counter(want)
    # In topological order, and every kind of link and status occurs.
    order = [(r[0], r[4], r[5], r[1], r[2]) for r in got]
    assert order == sorted(order)
    assert {r[6] for r in got} >= {"ok", "open", "orphan", "repeated", "unnamed"}
    assert {r[7] for r in got} >= {"ok", "unknown tool", "no object", "missing:query", "type:limit"}
