"""Adjacency-table shredding of deeply nested records into related flat tables.

``shred`` turns the nested JSON columns of each record into one node table: (record key, node, parent, label,
ordinal, scalar). Object nodes have a number and no scalar; scalar nodes have no number and hang on their object.
``entities`` joins the object nodes with their scalar children and pivots these into columns: one row per entity,
linked to its parent entity and its record. ``adjacency`` is the whole table of nodes at any depth, from which the
values can be rebuilt; ``shred`` holds the nodes of the child tables, which cost less.

The number of an object node is its place (``node_number``), so the position of the parent comes from the link itself,
without a self-join. Object and scalar children meet in one aggregation by (key, object), which is combined on the
map side: all nodes of a record come from one call, so about one row per entity is shuffled, not one per node. A
record is the unit of work, so a hot source or key doesn't skew anything.

Defined results. Null, blank or undecodable JSON has no nodes; an array written as JSON text counts like the array; a
lone object in place of an array is child 0; a null element keeps its position but is no child; elements that are
neither object nor null (a number in tool_calls) are no children. Rows without a key have no nodes; different rows
under one key stay apart by a hash of their content, rows repeated whole under one key count once. Extra columns are
ignored, also those named like the columns of the result.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomfold.functions.decode import compact, decode, inner, items, messages_of
from loomfold.session import ship, spread

NODE = "array<struct<row_hash:bigint,node:bigint,parent:bigint,label:string,ordinal:int,scalar:string>>"
NODE_ARROW = pa.struct([("row_hash", pa.int64()), ("node", pa.int64()), ("parent", pa.int64()), ("label", pa.string()), ("ordinal", pa.int32()), ("scalar", pa.string())])

#: Entities on the first level, and child kinds: label, number of the parent's label, number among its children.
FIRST = {"message": 1, "tool": 2, "lineage": 3}
CHILDREN = {"call": ("tool_call", "message", 1), "response": ("tool_response", "message", 2), "param": ("param", "tool", 1), "check": ("check", "lineage", 1)}
BITS = 28


def node_number(first: int, position: int, child: int = 0, child_position: int = 0) -> int:
    """The number of an object node: its place in the record. Positions are below 2 ** 28."""
    return (((first << BITS | position) << 2 | child) << BITS) | child_position


#: Keys of a parameter schema that are no parameters themselves.
SCHEMA_KEYS = {"type", "properties", "required", "description", "title", "additionalProperties", "$schema", "$defs", "definitions", "strict"}


def _is_schema(parameters: dict) -> bool:
    """A schema holds its parameters under properties; a plain map holds them itself, maybe one called type."""
    if isinstance(parameters.get("type"), (str, list)):
        return "properties" in parameters or set(parameters) <= SCHEMA_KEYS
    properties = inner(parameters.get("properties"))
    return isinstance(properties, dict) and "type" not in parameters and all(isinstance(x, dict) for x in properties.values())


def _nodes(messages: str | None, tools: str | None, metadata: str | None) -> list[tuple]:
    """The adjacency rows of one record, the record itself being node 0."""
    out: list[tuple] = []
    row = xxhash.xxh64_intdigest(repr((messages, tools, metadata)).encode("utf-8", "replace")) >> 1

    def scalar(parent: int, label: str, value) -> None:
        if value is not None:
            out.append((row, None, parent, label, 0, value if isinstance(value, str) else compact(value)))

    def first(label: str, ordinal: int) -> int:
        out.append((row, number := node_number(FIRST[label], ordinal), 0, label, ordinal, None))
        return number

    def below(parent: int, kind: str, ordinal: int) -> int:
        label, _, place = CHILDREN[kind]
        out.append((row, number := parent | place << BITS | ordinal, parent, label, ordinal, None))
        return number

    for i, m in enumerate(messages_of(messages) or []):
        if not isinstance(m := inner(m), dict):
            continue
        node = first("message", i)
        scalar(node, "role", m.get("role"))
        scalar(node, "content", m.get("content"))
        for k, call in enumerate(items(m.get("tool_calls"))):
            if isinstance(call := inner(call), dict):
                child = below(node, "call", k)
                function = inner(call.get("function", call))
                if isinstance(function, dict):
                    scalar(child, "name", function.get("name"))
                    scalar(child, "value", function.get("arguments"))
        for k, answer in enumerate(items(m.get("tool_responses"))):
            if isinstance(answer := inner(answer), dict):
                child = below(node, "response", k)
                scalar(child, "name", answer.get("name"))
                scalar(child, "value", answer.get("response"))
    for i, t in enumerate(items(decode(tools))):
        if not isinstance(t := inner(t), dict):
            continue
        node = first("tool", i)
        function = inner(t.get("function", t))
        if not isinstance(function, dict):
            continue
        scalar(node, "name", function.get("name"))
        scalar(node, "description", function.get("description"))
        parameters = inner(function.get("parameters"))
        if not isinstance(parameters, dict):
            continue
        properties = inner(parameters.get("properties")) if _is_schema(parameters) else parameters
        for k, (name, spec) in enumerate(properties.items() if isinstance(properties, dict) else ()):
            if (spec := inner(spec)) is None:
                continue
            child = below(node, "param", k)
            scalar(child, "name", name)
            scalar(child, "value", spec.get("type") if isinstance(spec, dict) else spec)
            if isinstance(spec, dict):
                scalar(child, "description", spec.get("description"))
    meta = decode(metadata)
    for i, step in enumerate(items(meta.get("lineage")) if isinstance(meta, dict) else ()):
        if not isinstance(step := inner(step), dict):
            continue
        node = first("lineage", i)
        scalar(node, "name", step.get("step"))
        for k, c in enumerate(items(step.get("checks"))):
            if isinstance(c := inner(c), dict):
                child = below(node, "check", k)
                scalar(child, "name", c.get("name"))
                scalar(child, "value", c.get("ok"))
    return out


def _shred_arrays(messages: pa.Array, tools: pa.Array, metadata: pa.Array) -> pa.Array:
    """The node lists of a batch of records."""
    return _listed([_nodes(*row) for row in zip(messages.to_pylist(), tools.to_pylist(), metadata.to_pylist())])


def _listed(lists: list[list[tuple]]) -> pa.Array:
    flat = list(zip(*(node for nodes in lists for node in nodes))) or [()] * len(NODE_ARROW)
    structs = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(flat, NODE_ARROW)], fields=list(NODE_ARROW))
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, lists)], dtype=np.int32), structs)


def shred(records: DataFrame, key: str = "rec_no") -> DataFrame:
    """The node table (key, row_hash, node, parent, label, ordinal, scalar) of records with messages, tools and metadata."""
    ship(records.sparkSession)
    rows = spread(records.where(F.col(key).isNotNull()).select(key, "messages", "tools", "metadata"))
    nodes = F.explode(F.arrow_udf(_shred_arrays, NODE)("messages", "tools", "metadata")).alias("n")
    return rows.select(key, nodes).select(key, "n.*")


def _adjacency(values: dict[str, str | None]) -> list[tuple]:
    """All nodes of a record at any depth, the record itself being node 0."""
    out: list[tuple] = []
    row = xxhash.xxh64_intdigest(repr(tuple(values.values())).encode("utf-8", "replace")) >> 1
    stack = [(0, label, i, decode(text)) for i, (label, text) in enumerate(values.items())][::-1]
    number = 0
    while stack:
        parent, label, ordinal, value = stack.pop()
        value = inner(value)
        if not isinstance(value, (dict, list)):
            out.append((row, None, parent, label, ordinal, json.dumps(value, ensure_ascii=False)))
            continue
        number += 1
        out.append((row, number, parent, label, ordinal, None if isinstance(value, dict) else "[]"))
        parts = value.items() if isinstance(value, dict) else (("[]", v) for v in value)
        stack += [(number, k, i, v) for i, (k, v) in enumerate(parts)][::-1]
    return out


def adjacency(records: DataFrame, columns: tuple[str, ...] = ("messages", "tools", "metadata"), key: str = "rec_no") -> DataFrame:
    """The whole node table (key, row_hash, node, parent, label, ordinal, scalar) of JSON columns, at any depth.

    Objects and arrays have a number, arrays the scalar "[]"; all else hangs as scalar, as JSON text, on its object or
    array by label and ordinal, nulls included, so the values can be rebuilt. JSON text inside JSON is opened. Columns
    are the nodes below the record, null where they can't be decoded. One narrow pass; rows without a key have no nodes.
    """
    ship(records.sparkSession)

    def arrays(*given: pa.Array) -> pa.Array:
        return _listed([_adjacency(dict(zip(columns, row))) for row in zip(*(x.to_pylist() for x in given))])

    rows = spread(records.where(F.col(key).isNotNull()).select(key, *columns))
    return rows.select(key, F.explode(F.arrow_udf(arrays, NODE)(*columns)).alias("n")).select(key, "n.*")


def rebuilt(nodes: list[tuple]) -> dict:
    """The values of the columns of one record from its rows (node, parent, label, ordinal, scalar)."""
    held: dict[int, object] = {0: {}}
    for node, parent, label, ordinal, scalar in sorted(nodes, key=lambda x: (x[1], x[3])):
        value = ([] if scalar == "[]" else {}) if node is not None else json.loads(scalar)
        held[node] = value if node is not None else held.get(node)
        owner = held[parent]
        owner.append(value) if isinstance(owner, list) else owner.__setitem__(label, value)
    return held[0]


def entities(nodes: DataFrame, columns: tuple[str, ...] = (), key: str = "rec_no") -> DataFrame:
    """One row per object node: (key, row_hash, node, parent, ordinal) and the scalar children of these labels as columns.

    The join of the objects with their scalar children and the pivot are one aggregation by the number of the object.
    """
    return nodes.groupBy(key, "row_hash", F.coalesce("node", "parent").alias("node")).agg(
        F.max(F.when(F.col("node").isNotNull(), F.col("parent"))).alias("parent"),
        F.max(F.when(F.col("node").isNotNull(), F.col("ordinal"))).alias("ordinal"),
        *(F.max(F.when(F.col("label") == c, F.col("scalar"))).alias(c) for c in columns),
    ).where(F.col("parent").isNotNull())


def child_tables(records: DataFrame, key: str = "rec_no") -> DataFrame:
    """All child entities of records with the link to their parent entity.

    (key, child_kind, parent_pos, child_pos, parent_name, name, value): one row per call, response, parameter and
    lineage check; parent_name is the role, tool name or lineage step of the parent.
    """
    flat = entities(shred(records, key), ("name", "value", "role"), key)
    owner = F.when(F.col("parent") == 0, F.col("node")).otherwise(F.col("parent"))
    family = Window.partitionBy(key, "row_hash", owner)
    named = flat.withColumn("parent_name", F.max(F.when(F.col("parent") == 0, F.coalesce("name", "role"))).over(family))
    place = F.concat_ws("/", F.shiftright("node", 2 * BITS + 2), F.shiftright("node", BITS).bitwiseAND(3))
    kinds = F.create_map(*(F.lit(x) for kind, (_, parent, child) in CHILDREN.items() for x in (f"{FIRST[parent]}/{child}", kind)))
    return named.where(F.col("parent") != 0).select(
        key, kinds[place].alias("child_kind"), F.shiftright("parent", BITS + 2).bitwiseAND((1 << BITS) - 1).alias("parent_pos"),
        F.col("ordinal").cast("bigint").alias("child_pos"), "parent_name", "name", "value",
    )
