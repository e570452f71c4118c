"""Schemas: the eight columns on disk and the typed record that operators work on."""

from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql.pandas.types import from_arrow_schema

from loomfold.functions.jsonx import encode

ON_DISK = "id string, source string, source_subset string, messages string, tools string, tool_names array<string>, quality string, metadata string"
ROLES = ("system", "user", "assistant", "tool")

_CALL = pa.struct([("name", pa.string()), ("arguments", pa.string())])
_ANSWER = pa.struct([("name", pa.string()), ("response", pa.string()), ("response_is_str", pa.bool_())])
_MESSAGE = pa.struct([("role", pa.string()), ("content", pa.string()), ("content_is_json", pa.bool_()), ("tool_calls", pa.list_(_CALL)), ("tool_responses", pa.list_(_ANSWER))])
_TOOL = pa.struct([("name", pa.string()), ("description", pa.string()), ("parameters", pa.string())])
_ARROW = pa.schema([
    ("ord", pa.int64()), ("source", pa.string()), ("source_subset", pa.string()),
    ("messages", pa.list_(_MESSAGE)), ("tools", pa.list_(_TOOL)), ("tool_names", pa.list_(pa.string())),
    ("instance_id", pa.string()), ("trajectory_id", pa.string()), ("repo", pa.string()), ("no_call_expected", pa.bool_()),
    ("resolved", pa.bool_()), ("reward", pa.float64()), ("curated", pa.bool_()),
    ("content_hash", pa.string()), ("bands", pa.list_(pa.string())),
    ("messages_json", pa.string()), ("tools_json", pa.string()), ("metadata_json", pa.string()), ("error", pa.string()),
])
#: The typed record; spark: the same as Spark type.
CANONICAL = SimpleNamespace(arrow=_ARROW, spark=from_arrow_schema(_ARROW))


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else encode(value)


def _number(value) -> float:
    try:
        return float(value)
    except (TypeError, ValueError):
        return 0.0


def typed_messages(messages: list[dict]) -> list[dict]:
    """Messages as the typed form: JSON text where a value isn't text."""
    return [
        {
            "role": _text(m.get("role")),
            "content": _text(m.get("content")),
            "content_is_json": m.get("content") is not None and not isinstance(m.get("content"), str),
            "tool_calls": [{"name": _text(c["function"].get("name")), "arguments": encode(c["function"].get("arguments"))} for c in m.get("tool_calls") or ()],
            "tool_responses": [
                {"name": r.get("name"), "response": _text(r.get("response")), "response_is_str": isinstance(r.get("response"), str)} for r in m.get("tool_responses") or ()
            ],
        }
        for m in messages
    ]


def canonical_row(ord_, source, subset, messages=None, tools=None, names=None, metadata=None, signals=None, content_hash=None, bands=None, error=None) -> dict:
    """A typed record of canonical parts; only ``error`` where there are none."""
    own = {"ord": ord_, "source": source, "source_subset": subset, "error": error}
    if error is not None:
        return own
    metadata, signals = metadata or {}, signals or {}
    return own | {
        "messages": typed_messages(messages),
        "tools": [{"name": t["function"]["name"], "description": t["function"]["description"], "parameters": encode(t["function"]["parameters"])} for t in tools],
        "tool_names": names,
        "instance_id": _text(metadata.get("instance_id")), "trajectory_id": _text(metadata.get("trajectory_id")), "repo": _text(metadata.get("repo")),
        "no_call_expected": bool(metadata.get("no_call_expected")),
        "resolved": signals.get("resolved") if isinstance(signals.get("resolved"), bool) else None,
        "reward": _number(signals.get("reward")), "curated": bool(signals.get("curated")),
        "content_hash": content_hash, "bands": bands,
        "messages_json": encode(messages), "tools_json": encode(tools), "metadata_json": encode(metadata),
    }
