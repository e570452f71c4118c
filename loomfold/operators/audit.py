"""Defects of written records, by row, tool, message, call and response, counted in one pass over five columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfold.functions.text import trimmed
from loomfold.schema import ROLES
from loomfold.session import spread

#: Marks that must not be left in contents (fixed values).
LEAKS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>", "<|start_header_id|>", "[INST]", "[/INST]", "<functioncall>", "tool_declare")
OVERSIZED = 1_000_000

_MESSAGES = "array<struct<role:string,content:string,tool_calls:array<struct<function:struct<name:string,arguments:string>>>,tool_responses:array<struct<name:string,response:string>>>>"
_TOOLS = "array<struct<function:struct<name:string,parameters:string>>>"


def _some(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _many(name: str, times: Column) -> Column:
    """An array with a name so many times."""
    return F.array_repeat(F.lit(name), F.coalesce(times, F.lit(0)).cast("int"))


def _if(name: str, condition: Column) -> Column:
    return _many(name, _some(condition).cast("int"))


_STRICT = {"allowSingleQuotes": "false"}


def _decoded(text: Column, kind: str) -> Column:
    """JSON text as an array of this type; null where it is no JSON. Other JSON than arrays and objects is an empty array.

    The text is parsed once; only where that gives nothing it is looked at again.
    """
    array = F.when(text.rlike(r"[\]}]\s*$"), F.from_json(text, kind, _STRICT))
    return F.coalesce(array, F.when(F.try_parse_json(text).isNotNull(), F.array().cast(kind)))


def _keys(text: Column, path: str = "$") -> Column:
    return F.coalesce(F.json_object_keys(F.get_json_object(text, path)), F.array().cast("array<string>"))


def typed(rows: DataFrame) -> DataFrame:
    """Rows on disk with msgs and defs, typed; null where the JSON text can't be decoded.

    Parts of another type than they should have (a lone object, JSON text in place of an array) count as missing.
    """
    tools = F.coalesce(F.when(trimmed(F.col("tools")) != "", F.col("tools")), F.lit("[]"))
    decoded = spread(rows.select("id", "source", "messages", "tools", "tool_names")).select(
        "id", F.coalesce("source", F.lit("?")).alias("source"), F.length("messages").alias("size"), F.coalesce("tool_names", F.array().cast("array<string>")).alias("tool_names"),
        _decoded(F.col("messages"), _MESSAGES).alias("msgs"), _decoded(tools, _TOOLS).alias("tools"),
    )
    about = lambda t: F.struct(t["function"]["name"].alias("name"), _keys(t["function"]["parameters"]).alias("keys"), _keys(t["function"]["parameters"], "$.properties").alias("properties"))
    return decoded.withColumn("defs", F.transform("tools", about)).drop("tools")


def defects() -> Column:
    """All defects of a typed row, each as often as it occurs."""
    msgs = F.coalesce("msgs", F.array().cast(_MESSAGES))
    defs, names = F.coalesce("defs", F.array()), F.col("tool_names")
    calls = F.flatten(F.transform(msgs, lambda m: F.transform(F.coalesce(m["tool_calls"], F.array().cast("array<struct<function:struct<name:string,arguments:string>>>")), lambda c: c["function"])))
    answers = F.flatten(F.transform(msgs, lambda m: F.coalesce(m["tool_responses"], F.array().cast("array<struct<name:string,response:string>>"))))
    count = lambda array, test: F.size(F.filter(array, lambda x: _some(test(x))))
    contents = F.filter(msgs, lambda m: m["content"].isNotNull())
    named = lambda t: F.coalesce(t["name"], F.lit("")) != ""
    not_schema = lambda t: (F.size(t["keys"]) > 0) & ~(F.array_contains(t["keys"], "type") & F.array_contains(t["keys"], "properties"))
    leaked = lambda t: F.size(F.array_except(F.array(*map(F.lit, ("type", "properties", "required"))), t["properties"])) == 0
    marked = lambda m: F.exists(F.array(*map(F.lit, LEAKS)), lambda x: F.contains(m["content"], x))
    row = F.concat(
        _many("tool_missing_name", count(defs, lambda t: ~named(t))),
        _many("tool_params_not_jsonschema", count(defs, not_schema)),
        _many("schema_keys_leaked_as_args", count(defs, leaked)),
        _if("invalid_role", F.exists(msgs, lambda m: ~_some(m["role"].isin(*ROLES)))),
        _if("no_assistant_turn", ~F.exists(msgs, lambda m: _some(m["role"] == "assistant"))),
        _many("cot_leak", count(contents, lambda m: F.contains(m["content"], F.lit("<think>")))),
        _many("foreign_marker_leak", count(contents, marked)),
        _many("role_label_leak", count(contents, lambda m: F.lower(m["content"]).rlike(r"^\s*assistant[\n ]"))),
        _many("raw_function_xml", count(contents, lambda m: (m["role"] == "assistant") & F.contains(m["content"], F.lit("<function=")))),
        _many("args_not_object", count(calls, lambda c: ~_some(trimmed(c["arguments"]).rlike(r"^[\[{]")))),
        _many("undeclared_tool_call", F.when(F.size(names) > 0, count(calls, lambda c: ~_some(F.array_contains(names, c["name"]))))),
        _many("observation_prefix_leak", count(answers, lambda r: F.startswith(r["response"], F.lit("OBSERVATION:")))),
        _if("call_response_imbalance_gt1", (F.size(calls) > 0) & (F.size(answers) > 0) & (F.size(calls) - F.size(answers) > 1)),
    )
    sized = _if("oversized_row_gt_1MB", F.col("size") > OVERSIZED)
    decoded = F.concat(_if("tools_parse_error", F.col("defs").isNull()), row)
    return F.concat(sized, F.when(F.col("msgs").isNull(), F.array(F.lit("messages_parse_error"))).otherwise(decoded))


def by_source(rows: DataFrame) -> DataFrame:
    """(source, defect, occurrences, rows): defects counted by occurrence and by row, in one pass that builds them once."""
    found = typed(rows).select("source", defects().alias("all"))
    # the outer kind: for the other one a filter of empty arrays is put below, which builds all defects a second time
    each = found.select("source", "all", F.explode_outer(F.array_distinct("all")).alias("defect")).where("defect IS NOT NULL")
    times = F.size(F.filter("all", lambda x: x == F.col("defect")))
    return each.groupBy("source", "defect").agg(F.sum(times).alias("occurrences"), F.count("*").alias("rows"))


def totals(rows: DataFrame) -> DataFrame:
    """(defect, occurrences, rows, pct_occurrences, pct_rows) over all rows; percentages to three digits."""
    counted = by_source(rows).groupBy("defect").agg(F.sum("occurrences").alias("occurrences"), F.sum("rows").alias("rows"))
    n = F.broadcast(rows.agg(F.count("*").alias("n")))  # one row
    share = lambda c: F.round(F.lit(100.0) * F.col(c) / F.greatest("n", F.lit(1)), 3)
    return counted.join(n).select("defect", "occurrences", "rows", share("occurrences").alias("pct_occurrences"), share("rows").alias("pct_rows"))


def worst_sources(rows: DataFrame, sources: int = 6, each: int = 3) -> DataFrame:
    """(source, total, defect, occurrences, place): the sources with most defects and the most frequent of each."""
    counted = by_source(rows)
    total = counted.groupBy("source").agg(F.sum("occurrences").alias("total")).orderBy(F.desc("total"), "source").limit(sources)
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("occurrences"), "defect"))
    return counted.join(F.broadcast(total), "source").withColumn("place", place).where(F.col("place") <= each).select("source", "total", "defect", "occurrences", "place")


def collisions(rows: DataFrame) -> DataFrame:
    """(collisions, average_size): repeats of ids, null being one id, and the rounded mean of the length of messages.

    The count per id is combined on the map side, so an id that a third of all rows share is no hot group.
    """
    per_id = rows.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.length(F.coalesce("messages", F.lit("")))).alias("chars"))
    return per_id.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("collisions"),
        F.coalesce(F.bround(F.sum("chars") / F.greatest(F.sum("n"), F.lit(1))), F.lit(0.0)).cast("bigint").alias("average_size"),
    )
