import json

from loomfold.operators.shred import adjacency, rebuilt, child_tables, entities, shred

KINDS = "rec_no bigint, messages string, tools string, metadata string, label string, node int"


def rows(spark, *given):
    return spark.createDataFrame([(*g, "x", 1) for g in given], KINDS)


def found(df):
    return sorted((r.rec_no, r.child_kind, r.parent_pos, r.child_pos, r.name) for r in child_tables(df).collect())


def test_children_keep_links_and_positions(spark):
    call = {"function": {"name": "f", "arguments": {"a": 1}}}
    messages = [
        {"role": "user", "content": "q"},
        {"role": "assistant", "tool_calls": [call, None, call]},
        {"role": "tool", "tool_responses": {"name": "f", "response": "x"}},
        {"role": "assistant", "tool_calls": json.dumps([call])},
    ]
    tools = [
        {"type": "function", "function": {"name": "f", "parameters": {"type": "object", "properties": {"a": {"type": "int", "properties": {"z": {}}}, "b": {}}}}},
        {"name": "g", "parameters": {"type": {"type": "str"}, "q": {"type": "str"}}},
    ]
    metadata = {"lineage": [None, {"step": "s", "checks": [{"name": "c", "ok": True}, None]}]}
    df = rows(spark, (1, json.dumps(messages), json.dumps(tools), json.dumps(json.dumps(metadata))))
    assert found(df) == [
        (1, "call", 1, 0, "f"), (1, "call", 1, 2, "f"), (1, "call", 3, 0, "f"), (1, "check", 1, 0, "c"),
        (1, "param", 0, 0, "a"), (1, "param", 0, 1, "b"), (1, "param", 1, 0, "type"), (1, "param", 1, 1, "q"), (1, "response", 2, 0, "f"),
    ]


def test_nulls_bad_json_and_repeats(spark):
    one = json.dumps([{"role": "assistant", "tool_calls": [{"function": {"name": "f"}}, 3]}])
    df = rows(spark, (1, None, None, None), (2, '[{"role":', "", "nope"), (3, one, "[]", "{}"), (3, one, "[]", "{}"), (4, json.dumps(json.dumps(json.loads(one)[0])), None, None), (None, one, None, None))
    assert found(df) == [(3, "call", 0, 0, "f"), (4, "call", 0, 0, "f")]
    assert child_tables(rows(spark)).count() == 0


def test_scalars_are_pivoted(spark):
    df = rows(spark, (1, json.dumps([{"role": "assistant", "tool_calls": [{"function": {"name": "f", "arguments": {"a": 1}}}]}]), None, None))
    flat = {r.name or r.role: r for r in entities(shred(df), ("name", "value", "role")).collect()}
    assert flat["f"].value == '{"a":1}' and flat["f"].parent == flat["assistant"].node
    child = child_tables(df).first()
    assert child.parent_name == "assistant" and child.value == '{"a":1}'


def test_whole_node_tables_rebuild_the_values(spark):
    messages = [{"role": "user", "content": [{"type": "text", "text": "a"}, None, 3]}, None, {"tool_calls": {"function": {"arguments": {"deep": [[1, {"er": []}], {}]}}}}]
    metadata = {"a": None, "lineage": [{"checks": json.dumps([{"name": "x"}])}], "n": 1.5, "t": "[no json", "l": "[]"}
    rows = [(1, json.dumps(messages), None, json.dumps(metadata)), (2, "[{", "", "3"), (None, "[]", None, None)]
    nodes = adjacency(spark.createDataFrame(rows, "rec_no bigint, messages string, tools string, metadata string"))
    held = {}
    for r in nodes.collect():
        held.setdefault(r.rec_no, []).append((r.node, r.parent, r.label, r.ordinal, r.scalar))
    metadata["lineage"][0]["checks"] = [{"name": "x"}]
    assert rebuilt(held[1]) == {"messages": messages, "tools": None, "metadata": metadata | {"l": []}}
    assert rebuilt(held[2]) == {"messages": None, "tools": None, "metadata": 3} and set(held) == {1, 2}
