"""Text functions as columns: they stay in generated code. ``strict`` takes white space as Unicode has it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks of other chat templates that are removed, in this order (fixed values).
FOREIGN_MARKERS = (
    "<|im_start|>", "<|im_end|>", "<|im_system|>", "<|im_middle|>", "<|endoftext|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>",
    "[INST]", "[/INST]", "<s>", "</s>", "<|user|>", "<|assistant|>", "<|system|>", "tool_declare",
)
CONTENT_CAP, DOM_CAP = 200_000, 12_000
CONTENT_TAIL, DOM_TAIL = "\n…[content truncated]", "\n…[DOM truncated]"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed(x: str | Column, strict: bool = False) -> Column:
    """Without outer white space of any kind (trim() only knows the space)."""
    u = "(?U)" if strict else ""
    return F.regexp_replace(_c(x), rf"{u}^\s+|{u}\s+$", "")


def or_null(x: Column) -> Column:
    """Null for the empty text."""
    return F.when(x != "", x)


def strip_cot(x: str | Column) -> Column:
    """Without hidden reasoning, closed or running to the end; null if nothing is left. Null stays null, "" stays ""."""
    closed = F.regexp_replace(_c(x), r"(?is)<think>.*?</think>\s*", "")
    cut = trimmed(F.regexp_replace(closed, r"(?is)<think>.*$", ""))
    return F.when(_c(x) == "", _c(x)).otherwise(or_null(cut))


def strip_markers(x: str | Column) -> Column:
    """Without marks of other chat templates; null if nothing is left. Null stays null, "" stays ""."""
    out = _c(x)
    for marker in FOREIGN_MARKERS:
        out = F.replace(out, F.lit(marker), F.lit(""))
    return F.when(_c(x) == "", _c(x)).otherwise(or_null(trimmed(out)))


def capped(x: str | Column, most: int = CONTENT_CAP, tail: str = CONTENT_TAIL) -> Column:
    """At most so many characters and a tail that tells the cut."""
    return F.when(F.length(_c(x)) > most, F.concat(F.substring(_c(x), 1, most), F.lit(tail))).otherwise(_c(x))


def clean(x: str | Column) -> Column:
    """Content as it is kept: without reasoning and foreign marks, capped."""
    return capped(strip_markers(strip_cot(x)))


def cap_dom(x: str | Column) -> Column:
    """A page as it is kept; null is the empty text."""
    return capped(F.coalesce(_c(x), F.lit("")), DOM_CAP, DOM_TAIL)


def tool_name(x: str | Column) -> Column:
    """A stable identifier for any tool name; null, blank and pure punctuation become unknown_tool."""
    words = F.regexp_replace(trimmed(F.coalesce(_c(x), F.lit(""))), r"[^0-9a-zA-Z_]+", "_")
    bare = F.regexp_replace(words, r"^_+|_+$", "")
    return F.when(bare == "", F.lit("unknown_tool")).when(bare.rlike("^[0-9]"), F.concat(F.lit("fn_"), bare)).otherwise(bare)


def normal_text(x: str | Column, strict: bool = False) -> Column:
    """Lower case, white space collapsed; null is the empty text."""
    u = "(?U)" if strict else ""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), rf"{u}\s+", " ")))


def observation(x: str | Column) -> Column:
    """A tool's output as plain text: without the prefix that some traces put before it."""
    return trimmed(F.regexp_replace(_c(x), r"^OBSERVATION:\s*", ""))


def final_answer(action: str | Column) -> Column:
    """The text of a stop or note action in bracket syntax; the action itself where nothing is left."""
    bare = trimmed(F.regexp_replace(F.regexp_replace(_c(action), r"^\w+\s*\[?", ""), r"\]+$", ""))
    return F.coalesce(or_null(bare), _c(action))


def group_key(instance_id: str | Column, trajectory_id: str | Column, repo: str | Column) -> Column:
    """The identity of a task across sources, or null.

    An id whose part before the first dot ends in a number is an issue and stands without what follows; other ids
    stand whole but for a trailing run number; without an id the repository stands.
    """
    given = F.coalesce(or_null(_c(instance_id)), _c(trajectory_id), F.lit(""))
    inst = trimmed(given)
    issue = F.split_part(inst, F.lit("."), F.lit(1))
    run = F.regexp_replace(inst, r"(?i)_run\d+$", "")
    repo_key = F.concat(F.lit("swe::repo::"), F.lower(_c(repo)))
    return (
        F.when(issue.rlike(r"(?s)^.+?-\d+$"), F.concat(F.lit("swe::"), F.lower(issue)))
        .when(inst != "", F.concat(F.lit("swe::"), F.lower(run)))
        .when(_c(repo) != "", repo_key)
    )


def record_id(source: str | Column, config: str | Column, content_hash: str | Column) -> Column:
    """Source and config, slashes as underscores, at most 34 characters, then the hash of the content."""
    prefix = F.replace(F.concat(_c(source), F.lit("_"), _c(config)), F.lit("/"), F.lit("_"))
    return F.concat(F.substring(prefix, 1, 34), F.lit("_"), _c(content_hash))


# The same rules for values inside Arrow batches, where content is part of free-form JSON.

_COT, _COT_OPEN = re.compile(r"<think>.*?</think>\s*", re.I | re.S), re.compile(r"<think>.*\Z", re.I | re.S)
_NOT_NAME = re.compile(r"[^0-9a-zA-Z_]+")


def py_strip_cot(text: str | None) -> str | None:
    return (_COT_OPEN.sub("", _COT.sub("", text)).strip() or None) if text else text


def py_clean(value):
    """``clean`` of a value; other values than text pass."""
    if not isinstance(value, str) or not value:
        return value
    text = py_strip_cot(value) or ""
    for marker in FOREIGN_MARKERS:
        text = text.replace(marker, "")
    text = text.strip()
    return py_capped(text) if text else None


def py_capped(text: str, most: int = CONTENT_CAP, tail: str = CONTENT_TAIL) -> str:
    return text if len(text) <= most else text[:most] + tail


def py_tool_name(name) -> str:
    bare = _NOT_NAME.sub("_", str(name or "").strip()).strip("_")
    if not bare:
        return "unknown_tool"
    return f"fn_{bare}" if bare[0].isdigit() else bare
