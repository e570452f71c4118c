"""Mixing sources to target weights by temperature and budgeted block permutations.

The weight of a source at temperature exponent a is proportional to target ** a x natural ** (1 - a), with its share of
all tokens as natural weight: 1 gives the targets, 0 the natural mix. Where a target entropy is given instead, the
natural shares are exponentiated themselves, and the exponent is bisected to it. The total budget of tokens is, unless
given (as tokens or as a share of all), the largest at which the weights hold and no source is repeated more than it
may be; with a larger one the exponent is bisected to the largest that keeps the repetition limits. Planned and actual
shares are reported.

A source is drawn in whole passes over its documents and a rest, taken from a permutation by hash. The permutation is
cut into blocks of about ``BLOCK_TOKENS``: totals of blocks are aggregated, whole blocks go in by a running sum over
them, and only the block in which the budget ends is ordered by document, so no task holds a source, however large. What is
left where the next document is too long is filled from the permutation of the documents of at most a tenth of it.

Defined results. Targets that are null, 0, negative or without tokens draw nothing and are reported with an actual
share of 0; sources without target draw nothing. Sources are compared without outer spaces and letter case. Null or
blank texts have no or few tokens and go in with their pass. Repeated texts are documents of their own. Rows without
doc_id draw nothing. Empty tables give no draws. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomfold.llm.tokens import VOCABULARY, counted
from loomfold.session import written

BLOCK_TOKENS, STEPS, MAX_TARGETS = 1_000_000, 60, 20_000
#: Largest document, as a share of what is left, in each round of filling the rest.
FILLS = (1.0, 0.1, 0.1)


def bisect(low: float, high: float, holds, steps: int = STEPS) -> float:
    """The largest value between low and high that holds, if low does and what holds is a range from low on."""
    if holds(high):
        return high
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def normalized(weights: dict[str, float]) -> dict[str, float]:
    total = sum(weights.values())
    return {k: w / total for k, w in weights.items()} if total > 0 else {}


def tempered(target: dict[str, float], natural: dict[str, float], exponent: float) -> dict[str, float]:
    """Weights between the natural ones (0) and the targets (1), in proportion to target ** a x natural ** (1 - a)."""
    return normalized({k: target[k] ** exponent * natural[k] ** (1 - exponent) for k in target})


def entropy(weights: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def at_entropy(natural: dict[str, float], wanted: float) -> dict[str, float]:
    """Natural shares exponentiated so that their entropy is the wanted one: exponent 1 natural, 0 even."""
    if not natural:
        return {}
    exponent = bisect(0.0, 64.0, lambda a: entropy(normalized({k: w**a for k, w in natural.items()})) >= wanted)
    return normalized({k: w**exponent for k, w in natural.items()})


def plan(target: dict[str, float], tokens: dict[str, int], repeats: dict[str, int], budget: float | None = None) -> tuple[dict[str, float], float, float]:
    """(weights, budget, exponent) of the sources with a target and tokens."""
    usable = normalized({k: w for k, w in target.items() if w and w > 0 and tokens.get(k, 0) > 0 and repeats.get(k, 1) > 0})
    if not usable:
        return {}, 0.0, 1.0
    caps = {k: tokens[k] * repeats.get(k, 1) for k in usable}
    natural = normalized({k: float(tokens[k]) for k in usable})
    if budget is None:
        return usable, min(caps[k] / w for k, w in usable.items()), 1.0
    budget = min(budget, float(sum(caps.values())))
    fits = lambda a: all(w * budget <= caps[k] * (1 + 1e-9) for k, w in tempered(usable, natural, a).items())
    if not fits(0.0):  # more than any exponent can give: every source up to its limit
        return normalized({k: float(c) for k, c in caps.items()}), budget, 0.0
    exponent = bisect(0.0, 1.0, fits)
    return tempered(usable, natural, exponent), budget, exponent


def _rest(placed: DataFrame, rests: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens) of the start of the permutation of each source that fits into its rest."""
    running = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    blocks = totals.withColumn("before", F.coalesce(F.sum("block_tokens").over(running), F.lit(0))).join(rests, "source").where("before < rest")
    chosen = blocks.select("source", "block", "before", "rest", (F.col("before") + F.col("block_tokens") <= F.col("rest")).alias("whole"))
    joined = placed.join(chosen, ["source", "block"])
    inside = Window.partitionBy("source", "block").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    partial = joined.where("NOT whole").withColumn("sum", F.sum("n_tokens").over(inside)).where(F.col("before") + F.col("sum") <= F.col("rest"))
    return joined.where("whole").select("doc_id", "source", "n_tokens").unionByName(partial.select("doc_id", "source", "n_tokens"))


def mix(
    documents: DataFrame, targets: DataFrame, budget: float | None = None, seed: int = 1, vocabulary: str = VOCABULARY, share: float | None = None, target_entropy: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(draws, shares): draws (doc_id, source, n_tokens, repeats) and shares (source, target_share, planned_share, n_tokens, n_docs, most_repeats, actual_share).

    budget: tokens of the mix, or share: the same as a share of all tokens of the targeted sources. target_entropy: of
    the weights, in nats, in place of those of the targets; these then only tell the sources and their repeats.
    """
    spark = documents.sparkSession
    clean = lambda c: F.lower(F.trim(c))
    wanted = targets.where("source IS NOT NULL").groupBy(clean("source").alias("source")).agg(F.sum("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"))
    rows = wanted.limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    target = {r.source: float(r.weight or 0) for r in rows}
    repeats = {r.source: int(1 if r.max_repeats is None else r.max_repeats) for r in rows}
    drawn = documents.where("doc_id IS NOT NULL").withColumn("source", clean("source")).join(
        F.broadcast(wanted.where("weight > 0").select("source")), "source", "left_semi"
    )
    sized = written(counted(drawn, ("doc_id", "source"), vocabulary), "sizes")
    tokens = {r.source: int(r.n or 0) for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}  # at most as many as targets
    if target_entropy is not None:
        target = {k: 0.0 for k in target} | at_entropy(normalized({k: float(n) for k, n in tokens.items() if n > 0}), target_entropy)
    weights, total, _ = plan(target, tokens, repeats, share * sum(tokens.values()) if share is not None else budget)
    passes = {k: math.floor(w * total / tokens[k] + 1e-9) for k, w in weights.items()}
    quota = [(k, passes[k], repeats[k], max(1, -(-tokens[k] // BLOCK_TOKENS))) for k in weights]
    quotas = F.broadcast(spark.createDataFrame(quota or [("", 0, 0, 1)], "source string, passes int, cap int, blocks bigint"))  # MAX_TARGETS at most
    placed = sized.withColumn("place", F.xxhash64(F.lit(seed), "doc_id")).join(quotas, "source")
    placed = placed.withColumn("block", F.pmod("place", "blocks")).drop("passes", "cap", "blocks")
    rest = {k: max(0.0, w * total - passes[k] * tokens[k]) for k, w in weights.items()}
    extra = None
    for part in FILLS:
        fresh = placed if extra is None else placed.join(extra.select("doc_id"), "doc_id", "left_anti")
        rests = F.broadcast(spark.createDataFrame(list(rest.items()) or [("", 0.0)], "source string, rest double"))
        drawn = written(_rest(fresh.join(rests, "source").where(F.col("n_tokens") <= F.col("rest") * part).drop("rest"), rests), "extra")
        extra = drawn if extra is None else extra.unionByName(drawn)
        for r in drawn.groupBy("source").agg(F.sum("n_tokens").alias("got")).collect():  # one row per target
            rest[r.source] -= r.got
    both = sized.join(extra.select("doc_id", F.lit(1).alias("extra")), "doc_id", "left").join(quotas, "source")
    times = F.least(F.col("passes") + F.coalesce("extra", F.lit(0)), F.col("cap"))
    draws = both.select("doc_id", "source", "n_tokens", times.alias("repeats")).where("repeats > 0")
    used = draws.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("n_tokens"), F.count("*").alias("n_docs"), F.max("repeats").alias("most_repeats"))
    all_weight = sum(w for w in target.values() if w > 0) or 1.0
    listed = spark.createDataFrame([(k, max(w, 0.0) / all_weight, weights.get(k, 0.0)) for k, w in target.items()] or [("", 0.0, 0.0)], "source string, target_share double, planned_share double").where("source <> ''")
    told = listed.join(used, "source", "left").fillna(0, ["n_tokens", "n_docs", "most_repeats"])
    grand = F.sum("n_tokens").over(Window.partitionBy(F.lit(1)))  # one row per target
    shares = told.withColumn("actual_share", F.when(grand > 0, F.col("n_tokens") / grand).otherwise(0.0))
    return draws, shares.select("source", "target_share", "planned_share", "n_tokens", "n_docs", "most_repeats", "actual_share")
