"""Decoding of unevenly encoded nested parts: plain Python helpers that run inside Arrow batches.

Defined results: text that is not valid JSON decodes to ``None``; JSON text inside JSON counts like the value it
holds; a lone object where an array belongs is an array of one; null elements keep their position.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa

_NESTED = re.compile(r"\s*[\[{]")


def decode(text: str | None):
    """The value of a JSON column, or None where it is null, blank or cannot be decoded."""
    if text is None:
        return None
    try:
        value = json.loads(text)
        if isinstance(value, str):
            value = json.loads(value)
    except (ValueError, RecursionError):
        return None
    return value


def inner(value):
    """A nested value: JSON text of an object or array counts like the object or array, other text stays text."""
    if isinstance(value, str) and _NESTED.match(value):
        try:
            return json.loads(value)
        except (ValueError, RecursionError):
            return value
    return value


def items(value) -> list:
    """A nested array: text is decoded, a lone object is an array of one, anything else is empty."""
    value = inner(value)
    if isinstance(value, dict):
        return [value]
    return value if isinstance(value, list) else []


def messages_of(text: str | None) -> list | None:
    """The messages of a record, or None where they cannot be decoded (a null column counts as such)."""
    value = decode(text)
    if isinstance(value, dict):
        return [value]
    return value if isinstance(value, list) else None


def content_text(content) -> str | None:
    """Content as one text: parts are joined by line feeds; None where there is none."""
    if isinstance(content, dict):
        content = [content]
    if isinstance(content, list):
        return "\n".join(
            p if isinstance(p, str) else p.get("text") or ""
            for p in content
            if isinstance(p, str) or (isinstance(p, dict) and isinstance(p.get("text") or "", str))
        )
    return content if isinstance(content, str) else None


def compact(value) -> str | None:
    """JSON text of a nested value; None stays None."""
    return None if value is None else json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples in the order of their columns."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns)) if batch.num_columns else ()
