import json

import duckdb
from pyspark.sql import types as T

from paddock.llm.chat import format_chats

MESSAGE = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                        T.StructField("status", T.StringType())])
SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)},
           "get": {"where": ("object", True), "tags": ("array", False), "deep": ("boolean", False)}}


def call(i, name="add", arguments=None, after=()):
    return {"id": i, "name": name, "arguments": {"a": 1, "b": 2} if arguments is None else arguments,
            "after": list(after)}


def calls(*c, content=None):
    return json.dumps({"tool_calls": list(c)} | ({"content": content} if content else {}))


def result(i, content="ok"):
    return json.dumps({"tool_call_id": i, "content": content})


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", calls(call("x"), call("y", after=["x"]), content="wait")),
    (1, 2, "tool", result("y", {"z": 1, "a": [1.50, None]})), (1, 3, "tool", result("x")),
    (1, 4, "assistant", "done"),
    # against the order: p waits for q, q for r; r comes last, its result even before the calls
    (2, 0, "tool", result("r")), (2, 1, "assistant", calls(call("p", after=["q"]))),
    (2, 2, "assistant", calls(call("q", after=["r"]))), (2, 3, "assistant", calls(call("r"))),
    (2, 4, "tool", result("p")),
    # a cycle, an orphan, an unanswered call, duplicates
    (3, 0, "assistant", calls(call("a", after=["b"]), call("b", after=["a"]), call("c", after=["gone"]))),
    (3, 1, "tool", result("nobody")), (3, 2, "assistant", calls(call("c"))), (3, 3, "tool", result("c")),
    (3, 4, "tool", result("c", "again")),
    # arguments
    (4, 0, "assistant", calls(call("1", arguments={"a": 1.0, "b": 1e3}), call("2", arguments={"a": "1", "b": 2}),
                              call("3", arguments={"b": 2, "c": None}), call("4", arguments=[1]),
                              call("5", name="none"), call("6", arguments='{"b": 2, "a": 3}'),
                              call("7", "get", {"where": {"b": {"d": 1, "c": 2}, "a": []}, "deep": True}),
                              call("8", "get", {"where": [], "tags": {}}), call(None))),
    # odd messages
    (5, 0, None, None), (5, 1, "assistant", "{not json"), (5, 2, "assistant", "{}"), (5, 3, "tool", "{}"),
    (5, 4, "tool", None), (None, 0, "assistant", calls(call("x"))), (None, 1, "tool", result("x")),
    (6, 0, "user", "é \" \\ \n \u0001 /"), (6, 0, "user", "é \" \\ \n \u0001 /"), (None, None, None, None),
    (7, 0, "assistant", calls(call("d"))), (7, 0, "assistant", calls(call("d"))), (8, 0, "user", "long " * 50_000),
]


def formatted(stored, rows):
    return format_chats(stored([(*r, "clash") for r in rows], MESSAGE, "messages"), SCHEMAS).collect()


def test_links_order_and_validation(stored):
    got = formatted(stored, ROWS)
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.turn, r.idx), []).append(r)
    one = {k: v[0] for k, v in by.items()}
    assert [one[(1, t, i)].status for t, i in ((1, 0), (1, 1), (1, 2), (2, 0), (3, 0))] == [
        "message", "linked", "linked", "linked", "linked"]

    def order(conv):
        return [(r.kind, r.call_id) for r in sorted((r for r in got if r.conv_id == conv), key=lambda r: (
            r.place, r.level, r.step, r.turn, r.idx))]
    assert order(2) == [("call", "r"), ("result", "r"), ("call", "q"), ("call", "p"), ("result", "p")]
    assert order(1) == [("message", None), ("message", None), ("call", "x"), ("call", "y"),
                        ("result", "y"), ("result", "x"), ("message", None)]
    assert {one[(3, 0, i)].status for i in (1, 2)} == {"cycle"} and one[(3, 0, 3)].status == "linked"
    assert [one[(3, t, i)].status for t, i in ((1, 0), (2, 1), (3, 0), (4, 0))] == [
        "orphan", "duplicate", "linked", "duplicate"]
    assert [one[(4, 0, i)].errors for i in range(1, 10)] == [
        "", "not integer: a", "missing a; unexpected c", "arguments are no object", "unknown tool", "", "",
        "not array: tags; not object: where", "no identifier"]
    assert [one[(4, 0, i)].valid for i in (1, 2)] == [True, False]
    assert [one[(5, t, 0)].status for t in range(3)] == ["message"] * 3
    assert [one[(5, t, 0)].status for t in (3, 4)] == ["orphan"] * 2
    assert sorted(r.status for r in got if r.conv_id is None) == ["message", "orphan", "unanswered"]
    assert sorted(r.status for r in by[(7, 0, 1)]) == ["duplicate", "unanswered"]
    assert len(by[(6, 0, 0)]) == 2


def test_levels_of_any_graph(stored):
    """Chains, forks, joints and cycles, against a depth-first search."""
    import random
    draw = random.Random(12)
    rows, waits = [], {}
    for conv in range(30):
        names = [f"n{i}" for i in range(draw.randint(2, 14))]
        for turn, name in enumerate(names):
            after = [x for x in draw.sample(names, draw.choice([0, 1, 1, 1, min(2, len(names))])) if x != name]
            if conv % 3:   # no cycles: only later names
                after = [x for x in after if names.index(x) > turn]
            waits[(conv, name)] = (turn, after)
            rows.append((conv, turn, "assistant", calls(call(name, after=after))))
    rows += [(99, t, "assistant", calls(call(f"c{t}", after=[f"c{t + 1}"] if t < 40 else []))) for t in range(41)]
    waits |= {(99, f"c{t}"): (t, [f"c{t + 1}"] if t < 40 else []) for t in range(41)}

    def depth(conv, name, way=()):
        if name in way:
            return None
        turn, after = waits[(conv, name)]
        below = [depth(conv, x, (*way, name)) for x in after]
        if None in below:
            return None
        return max([b[0] + 1 for b in below], default=0), max([turn, *(b[1] for b in below)])
    got = {(r.conv_id, r.call_id): r for r in formatted(stored, rows)}
    reordered = {c for (c, n), (t, after) in waits.items() if any(waits[(c, x)][0] >= t for x in after)}
    for (conv, name), (turn, _) in waits.items():
        r, want = got[(conv, name)], depth(conv, name)
        if conv not in reordered:
            assert (r.place, r.level) == (turn, 0)
        elif want is None:
            assert r.status == "cycle" and r.place == turn
        else:
            assert (r.level, r.place) == want and r.status == "unanswered"


def canonical(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_canonical_json(stored):
    got = formatted(stored, ROWS)
    for r in got:
        value = json.loads(r.message_json)
        assert "\n" not in r.message_json
        if r.kind != "call":
            assert r.message_json == canonical(value)
    deep = next(r for r in got if r.conv_id == 4 and r.call_id == "7")
    assert deep.message_json == canonical({"role": "assistant", "tool_calls": [{
        "id": "7", "name": "get", "arguments": {"where": {"b": {"d": 1, "c": 2}, "a": []}, "deep": True}}]})
    text = next(r for r in got if r.conv_id == 1 and r.turn == 2)
    assert json.loads(text.message_json)["content"] == '{"a":[1.5,null],"z":1}'


def test_no_rows(stored):
    assert formatted(stored, []) == []


def test_plan_is_native(stored):
    table = stored([(*r, "clash") for r in ROWS], MESSAGE, "messages")
    plan = format_chats(table, SCHEMAS)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_oracle(spark):
    from paddock.llm.queries import ORACLES, op10_chat_formatting
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    own = op10_chat_formatting(spark, sf)
    cols = sorted(own.columns)
    want = sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES['op10_chat_formatting']})").fetchall(), key=str)
    assert sorted((tuple(r) for r in own.select(*cols).collect()), key=str) == want
