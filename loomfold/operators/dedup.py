"""Three layers of deduplication with the exact outcome of one ordered pass that registers only kept rows.

A row is dropped if an earlier kept row shares one of its tokens: its content hash, its group key, or a minwise band.
Rounds settle this without a sequential pass: a row whose order is the smallest undecided one in all its tokens is
kept, undecided rows that share a token with it are dropped, and so on until none is left. Rows are never expanded
into pairs. A token that a third of all rows share is one aggregated minimum; where it is joined back, its rows are
spread over ``SALTS`` tasks. Such hot tokens hold at least a thousandth of all token rows each, so there are at most a
thousand of them, whatever the size of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfold.functions.text import group_key
from loomfold.session import written

#: Layers by precedence of the reason, with the letter of their tokens.
LAYERS = (("e", "exact"), ("s", "swe_group"), ("b", "near"))
#: Share of all token rows from which a token is hot, rows below which none is, and tasks for a hot one.
HOT_SHARE, HOT_ROWS, SALTS = 1_000, 20_000, 64


def tokens(records: DataFrame, near: bool = True, scope: str | None = None) -> DataFrame:
    """(ord, layer, token) of typed records; rows without group key or shingles have none of that layer.

    scope: a column within whose values rows are compared, or None for all rows together. A narrow pass.
    """
    prefix = F.coalesce(F.col(scope), F.lit("")) if scope else F.lit("")
    token = lambda layer, *parts: F.struct(F.lit(layer).alias("layer"), F.when(parts[-1].isNotNull(), F.md5(F.concat_ws("|", F.lit(layer), prefix, *parts))).alias("token"))
    made = [F.array(token("e", F.col("content_hash")), token("s", group_key("instance_id", "trajectory_id", "repo")))]
    if near:
        made.append(F.transform(F.coalesce("bands", F.array().cast("array<string>")), lambda key, band: token("b", band.cast("string"), key)))
    return records.select("ord", F.explode(F.concat(*made)).alias("x")).select("ord", "x.layer", "x.token").where("token IS NOT NULL")


class _Salted:
    """Joins by token in which the rows of hot tokens are spread over many tasks."""

    def __init__(self, rows: DataFrame):
        counts = rows.groupBy("token").agg(F.count("*").alias("n"))
        least = F.lit(max(rows.count() // HOT_SHARE, HOT_ROWS))
        self.hot = [r.token for r in counts.where(F.col("n") > least).select("token").collect()]  # at most HOT_SHARE
        self.spark = rows.sparkSession

    def _is_hot(self) -> Column:
        return F.array_contains(F.array(*map(F.lit, self.hot)), F.col("token"))

    def rows(self, df: DataFrame) -> DataFrame:
        """Rows (ord, token, ...) with their salt."""
        own = F.pmod(F.xxhash64("ord"), F.lit(SALTS)).cast("int")
        return df.withColumn("salt", F.when(self._is_hot(), own).otherwise(0) if self.hot else F.lit(0))

    def sides(self, df: DataFrame) -> DataFrame:
        """One row per token, with hot ones once per salt."""
        if not self.hot:
            return df.withColumn("salt", F.lit(0))
        return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(self._is_hot(), F.lit(SALTS - 1)).otherwise(0))))

    def join(self, rows: DataFrame, by_token: DataFrame, how: str = "inner") -> DataFrame:
        return self.rows(rows).join(self.sides(by_token), ["token", "salt"], how).drop("salt")


def resolve(token_rows: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """(ord, reason): reason is null for kept rows, else the first layer in which an earlier kept row has the token.

    blocked: tokens (token) that count as registered before all rows.
    """
    rows = written(token_rows.select("ord", "layer", "token").distinct(), "tokens")
    salted = _Salted(rows)
    order = F.create_map(*(F.lit(x) for i, (letter, _) in enumerate(LAYERS) for x in (letter, i)))
    reason_of = F.create_map(*(F.lit(x) for i, (_, name) in enumerate(LAYERS) for x in (i, name)))
    registered = None if blocked is None else blocked.select("token", F.lit(-1).cast("bigint").alias("by")).distinct()
    open_rows = rows
    if registered is not None:
        hit = salted.join(rows, registered.select("token"), "left_semi").select("ord").distinct()
        open_rows = written(rows.join(hit, "ord", "left_anti"), "open")
    holders = [] if registered is None else [registered]
    while not open_rows.isEmpty():
        first = open_rows.groupBy("token").agg(F.min("ord").alias("first"))
        mine = salted.join(open_rows, first).groupBy("ord").agg(F.min(F.col("first") == F.col("ord")).alias("kept"))
        flagged = written(open_rows.join(mine, "ord"), "flagged")
        # a kept row is alone with its tokens among the kept ones: one row per token
        kept = flagged.where("kept").select("token", F.col("ord").alias("by"))
        holders.append(kept)
        left = flagged.where("NOT kept").drop("kept")
        gone = salted.join(left, kept.select("token"), "left_semi").select("ord").distinct()
        open_rows = written(left.join(gone, "ord", "left_anti"), "open")
    by_token = None
    for part in holders:
        by_token = part if by_token is None else by_token.union(part)
    if by_token is None:
        return rows.select("ord", F.lit(None).cast("string").alias("reason"))
    joined = salted.join(rows, by_token.groupBy("token").agg(F.min("by").alias("by")), "left")
    earlier = F.min(F.when(F.col("by") < F.col("ord"), order[F.col("layer")]))
    return joined.groupBy("ord").agg(earlier.alias("layer_no")).select("ord", reason_of[F.col("layer_no")].alias("reason"))


def deduplicate(records: DataFrame, against: DataFrame | None = None, near: bool = True, scope: str | None = None) -> DataFrame:
    """Typed records with ``dup_reason``: null where kept. against: content hashes (hash) of a reference set.

    Rows that the reference set holds are duplicates of the exact layer and never register. Only (ord, content_hash)
    and tokens are compared; the records themselves are joined once, with the verdicts. The records are read twice:
    give a written table.
    """
    verdicts = None
    if against is not None:
        known = against.select(F.col("hash").alias("content_hash")).distinct()
        hit = records.select("ord", "content_hash").join(known, "content_hash", "left_semi")
        verdicts = written(hit.select("ord", F.lit("exact").alias("dup_reason")), "known")
    own = tokens(records, near, scope)
    told = resolve(own if verdicts is None else own.join(verdicts.select("ord"), "ord", "left_anti")).withColumnRenamed("reason", "dup_reason")
    dropped = told.where("dup_reason IS NOT NULL")
    return records.join(dropped if verdicts is None else dropped.union(verdicts), "ord", "left")


def stats(deduplicated: DataFrame) -> DataFrame:
    """(seen, kept, exact, swe_group, near) in one row."""
    is_ = lambda name: F.count_if(F.col("dup_reason") == name).alias(name)
    return deduplicated.agg(F.count("*").alias("seen"), F.count_if(F.col("dup_reason").isNull()).alias("kept"), *(is_(name) for _, name in LAYERS))


def first_wins(rows: DataFrame, key, order: str = "ord") -> DataFrame:
    """The first row of each key by order: a minimum per key and a semi-join, no sort of a group; null keys are one group."""
    keyed = rows.withColumn("_key", key)
    first = keyed.groupBy("_key").agg(F.min(order).alias(order))
    return keyed.join(first.select(order), order, "left_semi").drop("_key")
