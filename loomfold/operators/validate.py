"""Validation of typed records as column expressions: the first rule that fails names the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfold.functions.text import trimmed
from loomfold.schema import ROLES


def _known(role: Column) -> Column:
    return F.coalesce(role.isin(*ROLES), F.lit(False))


def _is_object(arguments: Column) -> Column:
    return F.coalesce(trimmed(arguments).rlike(r"^[\[{]"), F.lit(False))


def calls_of(messages: str = "messages") -> Column:
    """All calls of a record in order."""
    return F.flatten(F.transform(F.coalesce(messages, F.array()), lambda m: F.coalesce(m["tool_calls"], F.array())))


def reason(messages: str = "messages", tool_names: str = "tool_names") -> Column:
    """Why a record isn't well-formed, or null.

    In this order: no messages; a role outside of the four (the first such, null as None); no assistant turn; a call
    whose arguments are no object or list, or, if tools are declared, whose name is not, whichever comes first in the
    order of the calls; no call and no assistant content but white space. Content that is no text raised an error in
    that last check: finalize_error:AttributeError.
    """
    m, names = F.col(messages), F.coalesce(tool_names, F.array().cast("array<string>"))
    odd = F.filter(m, lambda x: ~_known(x["role"]))
    first_odd = F.get(F.transform(odd, lambda x: x["role"]), F.lit(0))
    calls = calls_of(messages)
    bad = F.filter(calls, lambda c: ~_is_object(c["arguments"]) | ((F.size(names) > 0) & ~F.coalesce(F.array_contains(names, c["name"]), F.lit(False))))
    first_bad = F.get(bad, F.lit(0))
    said = F.exists(m, lambda x: (x["role"] == "assistant") & ~F.coalesce(x["content_is_json"], F.lit(False)) & (trimmed(F.coalesce(x["content"], F.lit(""))) != ""))
    stuck = F.exists(m, lambda x: (x["role"] == "assistant") & F.coalesce(x["content_is_json"], F.lit(False)))
    return (
        F.when(F.coalesce(F.size(m), F.lit(0)) <= 0, F.lit("empty_messages"))
        .when(F.size(odd) > 0, F.concat(F.lit("bad_role:["), F.coalesce(F.concat(F.lit("'"), first_odd, F.lit("'")), F.lit("None")), F.lit("]")))
        .when(~F.exists(m, lambda x: x["role"] == "assistant"), F.lit("no_assistant_turn"))
        .when(F.size(bad) > 0, F.when(~_is_object(first_bad["arguments"]), F.lit("tool_call_args_not_object")).otherwise(F.concat(F.lit("undeclared_tool:"), F.coalesce(first_bad["name"], F.lit("None")))))
        .when((F.size(calls) == 0) & stuck & ~said, F.lit("finalize_error:AttributeError"))
        .when((F.size(calls) == 0) & ~said, F.lit("empty_assistant"))
    )


def validated(records: DataFrame) -> DataFrame:
    """Records with ``reason``: normalizer errors first, then the rules; null where well-formed.

    Rows that their normalizer dropped, where they were kept for counting, have the reason "dropped".
    """
    failed = F.when(F.col("error") == "dropped", F.lit("dropped")).when(F.col("error").isNotNull(), F.lit("normalizer_exception"))
    return records.withColumn("reason", F.coalesce(failed, reason()))
