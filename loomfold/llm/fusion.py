"""Best representative of each duplicate group: Bayesian fusion with copy detection.

Each row of a group claims a value for each field. Sources vote with an accuracy that is estimated together with the
probability of the values; sources that share false values more often than chance allows depend on each other, and a
copied vote is discounted. The posterior of a value is the sum of the votes for it and of a prior of bounded weight
for its best row: ``PRIOR`` for being of the largest trust, and again for being the most recent. A vote weighs at most
4.6, so a value without either needs several independent accurate sources against a row with both, and copies of one
source never add up to them. The value with the largest posterior survives, from its best row.

Where a definition demands that a row of top trust and recency wins against any number of votes (``exact``), that is
checked behind: a field whose choice is surpassed by another row in trust or in recency is taken from the row that no
other surpasses, if there is one. ``decided`` tells for each field what decided it: "votes" alone, "prior" against the
votes, or the "check" against both.

Scale: claims are first reduced to one per (group, field, source), so a group of a third of all rows becomes as many
claims as there are sources; all steps are aggregations that combine on the map side, then joins by (group, field).
The accuracies and the dependence of pairs of sources are bounded by the registry of sources, whose size is checked
(``MAX_SOURCES``); only pairs that depend on each other are shipped, once an executor.

Defined results. Usable is a value that is not null, blank or a word for no value; a field without one has no row.
Rows with a null or blank id belong to no group; unknown or null sources have trust 0 unless metadata names a known
one by hf_id; a missing or unreadable fetched_at is older than any. Whole repeats count as rows. Metadata that cannot
be decoded has no values. Extra columns are ignored.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfold.functions.decode import decode, rows_of
from loomfold.llm.chunkdedup import id_tail
from loomfold.session import ship, spread, written

FIELDS = ("license", "repo", "instance_id", "score", "source")
#: Words that stand for no value.
NO_VALUE = {"", "null", "none", "nil", "nan", "na", "n/a", "unknown", "tbd", "-", "--", "?", "missing", "undefined", "not available"}
#: Rounds of estimation, the assumed number of false values of a field, the share of copied values of a copier.
ROUNDS, FALSE_VALUES, COPY_RATE, MAX_SOURCES = 3, 10, 0.8, 1_000
#: Prior, in the unit of votes, of a row of the largest trust, and of the most recent one; dependence below which a pair counts as independent.
PRIOR, INDEPENDENT = 8.0, 0.02


def epoch(value) -> float | None:
    """Seconds since 1970 of UTC text in two layouts or of a number."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, float)):
        return float(value)
    text = str(value).strip()
    try:
        return float(text)
    except ValueError:
        pass
    try:
        at = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return (at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)).timestamp()


def _value(raw) -> str | None:
    """The value as text, or None where it stands for no value."""
    if raw is None or isinstance(raw, (dict, list, bool)):
        return None
    text = repr(raw) if isinstance(raw, float) else str(raw)
    return None if text.strip().lower() in NO_VALUE else text


def claims(records: DataFrame, sources: DataFrame, key: str = "rec_no") -> DataFrame:
    """(group_id, field_name, key, by, trust, fetched, value): the usable values of rows that share the end of an id."""
    ship(records.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = defaultdict(list)
            for tail, no, source, metadata, quality in rows_of([batch]):
                meta, judged = decode(metadata), decode(quality)
                meta, judged = meta if isinstance(meta, dict) else {}, judged if isinstance(judged, dict) else {}
                fields = [_value(x) for x in (*(meta.get(f) for f in FIELDS[:3]), judged.get("score"), source)]
                hub = meta.get("hf_id")
                for name, x in (("group_id", tail), ("key", no), ("by", source), ("hub", hub if isinstance(hub, str) else None), ("fetched", epoch(meta.get("fetched_at"))), ("values", fields)):
                    out[name].append(x)
            kinds = (("group_id", pa.string()), ("key", pa.int64()), ("by", pa.string()), ("hub", pa.string()), ("fetched", pa.float64()), ("values", pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in kinds], [n for n, _ in kinds])

    rows = records.select(id_tail().alias("group_id"), F.col(key).cast("bigint").alias("key"), "source", "metadata", "quality")
    groups = rows.where("group_id IS NOT NULL").groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1").select("group_id")
    shared = spread(rows).join(groups.hint("merge"), "group_id", "left_semi").select("group_id", "key", "source", "metadata", "quality")
    values = shared.mapInArrow(read, "group_id string, key bigint, by string, hub string, fetched double, values array<string>")
    clean = lambda c: F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    known = sources.select(clean("source_key").alias("known"), clean("hf_id").alias("hub_id"), "trust").dropDuplicates(["known"])
    by_name = known.select(F.col("known").alias("by_name"), F.col("trust").alias("t1"))
    by_hub = known.dropDuplicates(["hub_id"]).select("hub_id", F.col("known").alias("by_hub"), F.col("trust").alias("t2"))
    named = values.join(by_name, clean("by") == F.col("by_name"), "left").join(by_hub, clean("hub") == F.col("hub_id"), "left")
    fields = F.arrays_zip(F.array(*map(F.lit, FIELDS)).alias("f"), F.col("values").alias("v"))
    return named.select(
        "group_id", "key", F.coalesce("by_name", "by_hub", F.lit("")).alias("by"), F.coalesce("t1", "t2", F.lit(0)).alias("trust"),
        F.coalesce("fetched", F.lit(-1e18)).alias("fetched"), F.explode(fields).alias("c"),
    ).where("c.v IS NOT NULL").select("group_id", F.col("c.f").alias("field_name"), "key", "by", "trust", "fetched", F.col("c.v").alias("value"))


def _vote(accuracy: float) -> float:
    accuracy = min(max(accuracy, 0.05), 0.91)
    return math.log(FALSE_VALUES * accuracy / (1 - accuracy))


def value_votes(names: list[str], values: list[str], accuracy: dict[str, float], copies: dict[tuple[str, str], float]) -> dict[str, float]:
    """Votes for each value of one item; of dependent sources with one value the more accurate counts in full."""
    votes: dict[str, float] = {}
    counted: dict[str, list[str]] = defaultdict(list)
    for name, value in sorted(zip(names, values), key=lambda x: (-accuracy.get(x[0], 0.5), x[0])):
        own = 1.0
        for other in counted[value]:
            own *= 1 - COPY_RATE * copies.get((min(name, other), max(name, other)), 0.0)
        counted[value].append(name)
        votes[value] = votes.get(value, 0.0) + own * _vote(accuracy.get(name, 0.5))
    return votes


def probabilities(votes: dict[str, float]) -> dict[str, float]:
    """Posterior probabilities of the values of an item, with FALSE_VALUES possible others."""
    top = max([0.0, *votes.values()])
    weights = {v: math.exp(x - top) for v, x in votes.items()}
    total = sum(weights.values()) + max(0, FALSE_VALUES + 1 - len(votes)) * math.exp(-top)
    return {v: w / total for v, w in weights.items()}


def dependence(same_true: float, same_false: float, differ: float, accuracy: float) -> float:
    """The probability that two sources depend on each other, from what they share (prior 0.1)."""
    accuracy = min(max(accuracy, 0.05), 0.99)
    alone = (accuracy**2, (1 - accuracy) ** 2 / FALSE_VALUES)
    apart = max(1 - sum(alone), 1e-6)
    copied = (accuracy * COPY_RATE + alone[0] * (1 - COPY_RATE), (1 - accuracy) * COPY_RATE + alone[1] * (1 - COPY_RATE))
    odds = same_true * math.log(copied[0] / alone[0]) + same_false * math.log(copied[1] / alone[1]) + differ * math.log((apart * (1 - COPY_RATE)) / apart)
    return 1 / (1 + math.exp(min(700, max(-700, -(odds + math.log(0.1 / 0.9))))))


def _items(all_claims: DataFrame) -> DataFrame:
    """(group_id, field_name, names, values): the newest claim of each source, as sorted arrays as long as there are sources."""
    own = all_claims.groupBy("group_id", "field_name", "by").agg(F.max(F.struct("fetched", -F.col("key"), F.lower(F.trim("value")).alias("value"))).alias("c"))
    pairs = F.array_sort(F.collect_list(F.struct("by", "c.value")))
    return own.groupBy("group_id", "field_name").agg(pairs.alias("p")).select("group_id", "field_name", F.col("p.by").alias("names"), F.col("p.value").alias("values"))


def estimate(items: DataFrame, prior: dict[str, float], rounds: int = ROUNDS) -> tuple[dict[str, float], dict[tuple[str, str], float]]:
    """Accuracies of the sources and dependence of pairs of them; both bounded by the number of sources."""
    accuracy, copies = dict(prior), {}
    for _ in range(rounds):
        known = items.sparkSession.sparkContext.broadcast((accuracy, copies))  # bounded by the registry

        def tell(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            now, among = known.value
            single: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
            for names, values in rows_of(batches):
                likely = probabilities(value_votes(names, values, now, among))
                for i, (a, v) in enumerate(zip(names, values)):
                    own = single[(a, a)]
                    own[0] += likely[v]
                    own[1] += 1
                    for b, w in zip(names[i + 1 :], values[i + 1 :]):
                        pair = single[(min(a, b), max(a, b))]
                        if v == w:
                            pair[0] += likely[v]
                            pair[1] += 1 - likely[v]
                        else:
                            pair[2] += 1
            rows = [(*k, *x) for k, x in single.items()]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string()] * 2 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["a", "b", "x", "y", "z"])

        told = items.select("names", "values").mapInArrow(tell, "a string, b string, x double, y double, z double")
        found = told.groupBy("a", "b").agg(F.sum("x"), F.sum("y"), F.sum("z")).collect()  # at most sources x sources rows
        accuracy = dict(accuracy)
        for a, b, x, y, _z in found:
            if a == b:
                accuracy[a] = (x + 4 * prior.get(a, 0.5)) / (y + 4)
        depend = ((a, b, dependence(x, y, z, (accuracy.get(a, 0.5) + accuracy.get(b, 0.5)) / 2)) for a, b, x, y, z in found if a != b)
        copies = {(a, b): d for a, b, d in depend if d >= INDEPENDENT}
    return accuracy, copies


def fuse(records: DataFrame, sources: DataFrame, key: str = "rec_no", exact: bool = False) -> DataFrame:
    """One row per group and field: (group_no, field_name, rec_no, value, posterior, decided).

    group_no is the smallest key of the group's rows, rec_no the row the value is taken from.
    """
    registry = sources.select(F.lower(F.trim("source_key")), "trust").limit(MAX_SOURCES + 1).collect()
    if len(registry) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: their pairs don't fit the driver")
    prior = {name: 0.5 + 0.08 * min(max(trust or 0, 0), 5) for name, trust in registry if name}
    all_claims = written(claims(records, sources, key), "claims")
    items = written(_items(all_claims), "items")
    # every source says its own name: that tells nothing of its accuracy
    known = records.sparkSession.sparkContext.broadcast(estimate(items.where("field_name <> 'source'"), prior))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (group, field, value, vote, likely[value])
                for group, field, names, values in rows_of([batch])
                for votes in [value_votes(names, values, *known.value)]
                for likely in [probabilities(votes)]
                for value, vote in votes.items()
            ]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string()] * 3 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["group_id", "field_name", "plain", "vote", "posterior"])

    votes = items.mapInArrow(weigh, "group_id string, field_name string, plain string, vote double, posterior double")
    item = ["group_id", "field_name"]
    best = all_claims.groupBy(item).agg(F.max("trust").alias("most"), F.max("fetched").alias("newest"))
    blocks = all_claims.groupBy(*item, "trust", "fetched").agg(F.min(F.struct("key", "value")).alias("c"))
    blocks = blocks.join(best.hint("merge"), item).withColumn("rank", (F.col("trust") == F.col("most")).cast("int") + (F.col("fetched") == F.col("newest")).cast("int"))
    weighed = blocks.withColumn("plain", F.lower(F.trim("c.value"))).join(votes.hint("merge"), [*item, "plain"], "left")
    vote = F.coalesce("vote", F.lit(0.0))
    row = F.struct("c.key", "c.value", "plain", "posterior")
    order = lambda score: F.struct(score, F.col("trust"), F.col("fetched"), -F.col("c.key"))
    chosen = weighed.groupBy(item).agg(
        F.max_by(row, order(vote + F.col("rank") * PRIOR)).alias("b"),
        F.max_by("plain", order(vote)).alias("voted"),
        F.max_by(row, F.when(F.col("rank") == 2, F.struct("rank"))).alias("top"),
    )
    wrong = F.coalesce(F.col("top.key") != F.col("b.key"), F.lit(False)) if exact else F.lit(False)
    decided = F.when(wrong, "check").when(F.col("b.plain") == F.col("voted"), "votes").otherwise("prior")
    final = chosen.select(*item, F.when(wrong, F.col("top")).otherwise(F.col("b")).alias("b"), decided.alias("decided"))
    rows = records.select(id_tail().alias("group_id"), F.col(key).cast("bigint").alias("key"))
    numbers = rows.where("group_id IS NOT NULL").groupBy("group_id").agg(F.min("key").alias("group_no"), F.count("*").alias("n")).where("n > 1")
    return final.join(numbers.hint("merge"), "group_id").select("group_no", "field_name", F.col("b.key").alias("rec_no"), "b.value", "b.posterior", "decided")


def decisions(fused: DataFrame) -> DataFrame:
    """(field_name, decided, n): what decided how many fields."""
    return fused.groupBy("field_name", "decided").agg(F.count("*").alias("n"))


def survivors(fused: DataFrame) -> DataFrame:
    """One row per group: (group_no, license, repo, instance_id, score, source)."""
    return fused.groupBy("group_no").pivot("field_name", list(FIELDS)).agg(F.first("value"))
