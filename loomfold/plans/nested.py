"""Queries over nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomfold.operators.shred import adjacency, child_tables


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per child object of records, with its position in its parent and that of the parent."""
    records = spark.read.parquet(f"{sf_dir}/records.parquet")
    return child_tables(records).select("rec_no", "child_kind", "parent_pos", "child_pos")


def p1_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat child tables with names and values."""
    return child_tables(spark.read.parquet(f"{sf_dir}/records.parquet"))


def p1_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of messages, tools and metadata at any depth, with parent, label, ordinal and scalar."""
    return adjacency(spark.read.parquet(f"{sf_dir}/records.parquet")).select("rec_no", "node", "parent", "label", "ordinal", "scalar")


QUERIES = {"p1_found": p1_found, "p1_children": p1_children, "p1_nodes": p1_nodes}


def _elements(x: str) -> str:
    """SQL: the elements of a JSON array, of the array that JSON text holds, or of a lone object as array."""
    plain = "CASE json_type({0}) WHEN 'ARRAY' THEN json_extract({0}, '$[*]') WHEN 'OBJECT' THEN [({0})::JSON] ELSE {1} END"
    held = f"json_extract_string({x}, '$')"
    inner = f"CASE WHEN json_valid({held}) THEN {plain.format(held, '[]::JSON[]')} ELSE []::JSON[] END"
    return plain.format(x, f"CASE WHEN json_type({x}) = 'VARCHAR' THEN {inner} ELSE []::JSON[] END")


def _opened(x: str) -> str:
    """SQL: a JSON value, or the one that JSON text holds."""
    return f"CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid(json_extract_string({x}, '$')) THEN json_extract_string({x}, '$')::JSON ELSE {x} END"


def _children(kind: str, of: str, path: str) -> str:
    return f"""SELECT rec_no, '{kind}' AS child_kind, pos AS parent_pos, unnest(range(0, len(l))) AS child_pos, unnest(l) AS e
        FROM (SELECT rec_no, pos, {_elements(f"json_extract(e, '$.{path}')")} AS l FROM {of} WHERE json_type(e) = 'OBJECT')"""


def _top(name: str, of: str) -> str:
    return f"SELECT rec_no, unnest(range(0, len(l))) AS pos, unnest(l) AS e FROM (SELECT rec_no, CASE WHEN json_valid({name}) THEN {_elements(of)} ELSE []::JSON[] END AS l FROM records)"


SQL = {
    "p1_found": f"""
    WITH m AS ({_top("messages", "messages::JSON")}), t AS ({_top("tools", "tools::JSON")}), x AS ({_top("metadata", f"json_extract({_opened('metadata::JSON')}, '$.lineage')")}),
    f AS (SELECT rec_no, pos, {_opened("json_extract(coalesce(json_extract(e, '$.function'), e), '$.parameters')")} AS p FROM t WHERE json_type(e) = 'OBJECT'),
    s AS (SELECT rec_no, pos, CASE WHEN json_type(p, '$.type') IN ('VARCHAR', 'ARRAY') THEN json_extract(p, '$.properties') ELSE p END AS p FROM f WHERE json_type(p) = 'OBJECT'),
    k AS (SELECT rec_no, pos, unnest(range(0, len(json_keys(p)))) AS child_pos, unnest(json_keys(p)) AS name, p FROM s WHERE json_type(p) = 'OBJECT'),
    c AS ({_children("call", "m", "tool_calls")} UNION ALL {_children("response", "m", "tool_responses")} UNION ALL {_children("check", "x", "checks")})
    SELECT rec_no, child_kind, parent_pos::BIGINT AS parent_pos, child_pos::BIGINT AS child_pos FROM c WHERE json_type(e) = 'OBJECT'
    UNION ALL SELECT rec_no, 'param', pos::BIGINT, child_pos::BIGINT FROM k WHERE json_type(json_extract(p, concat('$."', name, '"'))) <> 'NULL'"""
}
