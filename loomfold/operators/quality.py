"""Heuristic quality score and tier of typed records, as column expressions in a fixed order of additions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfold.operators.validate import calls_of

HIGH, MEDIUM = 0.75, 0.5


def _d(x: float) -> Column:
    return F.lit(float(x))


def _schema_keys(parameters: Column, path: str) -> Column:
    return F.coalesce(F.json_object_keys(F.get_json_object(parameters, path)), F.array().cast("array<string>"))


def valid_calls(messages: str = "messages", tools: str = "tools") -> Column:
    """Calls whose arguments are an object with all required and, where properties are declared, no other arguments.

    The last definition of a name counts; calls of unknown tools aren't valid.
    """
    definitions = F.col(tools)

    def fits(c: Column) -> Column:
        known = F.filter(definitions, lambda t: t["name"] == c["name"])
        parameters = F.element_at(known, -1)["parameters"]
        given = F.json_object_keys(c["arguments"])
        required = F.coalesce(F.from_json(F.get_json_object(parameters, "$.required"), "array<string>"), F.array().cast("array<string>"))
        properties = _schema_keys(parameters, "$.properties")
        enough = F.size(F.array_except(required, given)) == 0
        exact = (F.size(properties) == 0) | (F.size(F.array_except(given, properties)) == 0)
        return (F.size(known) > 0) & given.isNotNull() & enough & exact

    return F.size(F.filter(calls_of(messages), lambda c: F.coalesce(fits(c), F.lit(False))))


def counts(messages: str = "messages", tools: str = "tools") -> dict[str, Column]:
    """Counts per record: turns, assistant and tool messages, calls, valid calls, characters of text contents."""
    m = F.col(messages)
    chars = F.aggregate(m, F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(F.coalesce(x["content_is_json"], F.lit(False)), 0).otherwise(F.coalesce(F.length(x["content"]), F.lit(0))))
    return {
        "n_turns": F.size(m),
        "n_assistant": F.size(F.filter(m, lambda x: x["role"] == "assistant")),
        "n_tool": F.size(F.filter(m, lambda x: x["role"] == "tool")),
        "n_tool_calls": F.size(calls_of(messages)),
        "n_valid_calls": valid_calls(messages, tools),
        "n_chars": chars,
    }


def raw_score() -> Column:
    """The score before it is cut to [0, 1], of the counts and signals of a record; additions in a fixed order."""
    calls, ratio = F.col("n_tool_calls"), F.col("n_valid_calls") / F.col("n_tool_calls")
    verified = F.coalesce(F.col("resolved"), F.lit(False)) | (F.coalesce("reward", _d(0)) >= 1.0)
    step = lambda condition, amount: F.when(condition, amount).otherwise(_d(0))
    steps = (
        step((calls > 0) & (F.col("n_tool") > 0), _d(0.15)),
        step(F.col("n_assistant") > 1, _d(0.05)),
        step(calls > 0, _d(0.15) * ratio - _d(0.10) * (_d(1) - ratio)),
        step((F.size("tool_names") > 0) & (calls > 0), _d(0.05)),
        step(verified, _d(0.15)),
        step(F.coalesce(~F.col("resolved"), F.lit(False)), _d(-0.05)),
        step(F.coalesce("curated", F.lit(False)), _d(0.10)),
        step(F.coalesce("no_call_expected", F.lit(False)), _d(0.03)),
        step((F.col("n_chars") < 40) & (calls == 0), _d(-0.20)),
        step(F.col("n_turns") < 2, _d(-0.10)),
    )
    score = _d(0.5)
    for amount in steps:
        score = score + amount
    return score


def tier(score: Column) -> Column:
    return F.when(score >= HIGH, "high").when(score >= MEDIUM, "medium").otherwise("low")


def scored(records: DataFrame) -> DataFrame:
    """Records with score, tier, curated_flag and the signals as ``quality`` (JSON text)."""
    counted = records.withColumns(counts()).withColumn("score", F.greatest(_d(0), F.least(_d(1), raw_score())))
    verified = F.coalesce(F.col("resolved"), F.lit(False)) | (F.coalesce("reward", _d(0)) >= 1.0)
    flag = lambda condition: F.when(condition, F.lit(True))
    signals = F.struct(
        F.col("n_turns"), F.col("n_tool_calls"), (F.col("n_assistant") > 1).alias("multi_turn"),
        F.when(F.col("n_tool_calls") > 0, F.round(F.col("n_valid_calls") / F.col("n_tool_calls"), 3)).alias("valid_arg_ratio"),
        flag(verified).alias("verified_success"), flag(F.coalesce("no_call_expected", F.lit(False))).alias("no_call_expected"),
        flag((F.col("n_chars") < 40) & (F.col("n_tool_calls") == 0)).alias("too_short"),
    )
    curated = F.coalesce("curated", F.lit(False)) | verified
    quality = F.to_json(F.struct(tier(F.col("score")).alias("tier"), F.round("score", 3).alias("score"), curated.alias("curated"), signals.alias("signals")))
    return counted.withColumns({"tier": tier(F.col("score")), "curated_flag": curated, "quality": quality})
