"""Records with texts that were cut off by field limits or in transit, and how often each source cuts.

Every content, every tool response and the messages text as a whole goes through the structural completeness check
(``completeness``). Where a text ends in a list item or tag, which need no full stop, a dictionary of such pieces inside
all texts tells whether the last piece is a whole one: a missing piece is a cut one. The baseline of a source is the
share of its texts that run on to their end without a terminator, all structures closed. In a source where that is the
habit (``HABIT`` of its texts or more) a missing terminator alone is no cut; open structures, marks and broken bytes
are. The baseline and the lengths at which most cuts fall are reported.

One narrow pass over the records writes the few findings and the pre-aggregated dictionary; only these are shuffled.
The dictionary is joined, not broadcast. No step depends on how many rows a source has.

Defined results. Messages that cannot be decoded are a cut of the text as a whole; null or blank messages are no text.
Null and empty contents are no texts and no cuts. Rows without a key are left out; repeated rows count each. Sources
are compared in lower case without outer spaces, null is the source "". Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfold.functions.decode import content_text, inner, items, messages_of, rows_of
from loomfold.llm.completeness import cut_reason, inner_pieces, last_piece
from loomfold.session import ship, spread, written

#: Times a piece must stand inside texts to count as whole: so many in small tables, this share of all pieces in large ones.
KNOWN, KNOWN_SHARE = 3, 1e-6
#: Share of unterminated texts from which on a source ends them so by habit, and texts it must have for that.
HABIT, LEAST_TEXTS = 0.5, 20


def texts_of(messages: list) -> Iterator[tuple[int, str, str]]:
    """(message number, role, text) of all contents and tool responses; responses have the role of a log."""
    for i, m in enumerate(messages):
        if not isinstance(m := inner(m), dict):
            continue
        role = m.get("role")
        if text := content_text(m.get("content")):
            yield i, role if isinstance(role, str) else "", text
        for answer in items(m.get("tool_responses")):
            if isinstance(answer := inner(answer), dict):
                response = answer.get("response")
                for part in response.values() if isinstance(response, dict) else [response]:
                    if isinstance(part, str) and part:
                        yield i, "log", part


def judged(text: str, role: str) -> str | None:
    """Why a text of this role counts as cut, or None."""
    if role == "log":
        return cut_reason(text, answer=False, log=True)
    return cut_reason(text, answer=role != "user")


def known_pieces(found: DataFrame) -> DataFrame:
    """(piece): the pieces that stand inside texts often enough, of rows (piece, n) of the dictionary."""
    counts = found.where("n IS NOT NULL AND piece IS NOT NULL").groupBy("piece").agg(F.sum("n").alias("times"))
    total = counts.agg(F.sum("times")).first()[0] or 0  # one number
    return counts.where(F.col("times") >= max(KNOWN, math.ceil(total * KNOWN_SHARE))).select("piece")


def _source(records: DataFrame):
    return F.coalesce(F.lower(F.trim("source")), F.lit("")) if "source" in records.columns else F.lit("")


FOUND = "key bigint, msg_no bigint, role string, reason string, piece string, length int, n bigint, source string, open_ends bigint"
_FOUND = pa.schema([("key", pa.int64()), ("msg_no", pa.int64()), ("role", pa.string()), ("reason", pa.string()), ("piece", pa.string()), ("length", pa.int32()), ("n", pa.int64()), ("source", pa.string()), ("open_ends", pa.int64())])


def findings(records: DataFrame, key: str = "rec_no") -> DataFrame:
    """A written table with three kinds of rows.

    (key, msg_no, role, reason, piece, length, source) of texts that are or may be cut, (piece, n) of the dictionary, and
    (source, n, open_ends) with the texts of a source and those that run on to their end without a terminator.
    """
    ship(records.sparkSession)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pieces, texts, ends = [], Counter(), Counter(), Counter()
            for no, text, source in rows_of([batch]):
                if text is None or not text.strip():
                    continue
                messages = messages_of(text)
                if messages is None:
                    rows.append((no, -1, "messages", "json", None, len(text), None, source, None))
                    continue
                for i, role, part in texts_of(messages):
                    reason = judged(part, role)
                    if role != "log":
                        pieces.update(inner_pieces(part))
                        texts[source] += 1
                        ends[source] += reason == "ending"
                    piece = last_piece(part) if reason is None and role != "log" else None
                    if reason or piece:
                        rows.append((no, i, role, reason, piece, len(part), None, source, None))
            rows += [(None, None, None, None, p, None, n, None, None) for p, n in pieces.items()]
            rows += [(None, None, None, None, None, None, n, s, ends[s]) for s, n in texts.items()]
            columns = list(zip(*rows)) or [()] * len(_FOUND)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    rows = spread(records.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint"), "messages", _source(records).alias("source")))
    return written(rows.mapInArrow(check, FOUND), "findings")


def baselines(found: DataFrame) -> DataFrame:
    """(source, n_texts, unterminated): the texts of each source and the share of them that end without a terminator."""
    counts = found.where("open_ends IS NOT NULL").groupBy("source").agg(F.sum("n").alias("n_texts"), F.sum("open_ends").alias("open_ends"))
    return counts.select("source", "n_texts", (F.col("open_ends") / F.col("n_texts")).alias("unterminated"))


def _cut(found: DataFrame) -> DataFrame:
    habit = baselines(found).where((F.col("unterminated") >= HABIT) & (F.col("n_texts") >= LEAST_TEXTS)).select("source", F.lit("ending").alias("reason"))
    sure = found.where("reason IS NOT NULL").join(habit, ["source", "reason"], "left_anti")
    pieces = found.where("key IS NOT NULL AND reason IS NULL").join(known_pieces(found), "piece", "left_anti").withColumn("reason", F.lit("piece"))
    return sure.unionByName(pieces.select(*sure.columns)).select("key", "msg_no", "role", "reason", "length")


def cut_texts(records: DataFrame, key: str = "rec_no") -> DataFrame:
    """(key, msg_no, role, reason, length) of the texts that were cut off; msg_no is -1 for the messages text as a whole."""
    return _cut(findings(records, key))


def truncated_records(records: DataFrame, key: str = "rec_no") -> DataFrame:
    """(key, n_cut, reasons): the records with at least one text that was cut off."""
    return cut_texts(records, key).groupBy("key").agg(F.count("*").alias("n_cut"), F.array_sort(F.collect_set("reason")).alias("reasons"))


def rates(records: DataFrame, key: str = "rec_no") -> DataFrame:
    """(source, n_records, n_truncated, rate, usual_length, unterminated): how often and where each source cuts, and its baseline."""
    named = records.select(F.col(key).cast("bigint").alias("key"), _source(records).alias("source"))
    found = findings(records, key)
    cut = _cut(found).groupBy("key").agg(F.max(F.when(F.col("msg_no") >= 0, F.col("length"))).alias("length"))
    joined = named.join(cut.withColumn("cut", F.lit(1)), "key", "left")
    counts = joined.groupBy("source", "length").agg(F.count("*").alias("n"), F.count("cut").alias("n_cut"))
    usual = F.max_by("length", F.when(F.col("length").isNotNull(), F.struct("n_cut", "length")))
    per_source = counts.groupBy("source").agg(F.sum("n").alias("n_records"), F.sum("n_cut").alias("n_truncated"), usual.alias("usual_length"))
    return per_source.join(baselines(found), "source", "left").select(
        "source", "n_records", "n_truncated", (F.col("n_truncated") / F.col("n_records")).alias("rate"), "usual_length", F.coalesce("unterminated", F.lit(0.0)).alias("unterminated"),
    )
