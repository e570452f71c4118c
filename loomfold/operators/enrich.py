"""Caps, provenance, defaults, ids and rows on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfold.functions.text import record_id


def capped(rows: DataFrame, key: str, order: str, cap: str) -> DataFrame:
    """The first rows of each key by order, up to the value of the cap column; null and 0 are no cap.

    Keys without a cap pass without a shuffle. For the others the position is a count of rows before: orders are cut
    into blocks, the sizes of blocks are aggregated, and only within blocks is there a sort, so a hot key has many tasks.
    """
    free = rows.where(F.coalesce(F.col(cap), F.lit(0)) <= 0)
    bound = rows.where(F.col(cap) > 0).withColumn("_block", F.floor(F.col(order) / 4096))
    sizes = bound.groupBy(key, "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).select(F.col(key).alias("_key"), F.col("_block").alias("_of"), "_before")
    inside = F.row_number().over(Window.partitionBy(key, "_block").orderBy(order))
    placed = bound.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_block") == F.col("_of"))).withColumn("_place", F.col("_before") + inside)
    return placed.where(F.col("_place") <= F.col(cap)).drop("_block", "_key", "_of", "_before", "_place").unionByName(free)


def effective_cap(cap: Column, limit: int | None) -> Column:
    """The cap of a subset with a limit for the run: the smaller one; 0 and null are none."""
    own = F.when(cap > 0, cap)
    return own if not limit else F.least(F.coalesce(own, F.lit(limit)), F.lit(limit))


def with_provenance(metadata: Column, columns: dict[str, Column]) -> Column:
    """Metadata (a map) with the columns that aren't null; these win."""
    given = F.create_map(*(x for name, c in columns.items() for x in (F.lit(name), c.cast("string"))))
    kept = F.map_filter(given, lambda _, v: v.isNotNull())
    others = F.map_filter(metadata, lambda k, _: ~F.array_contains(F.map_keys(kept), k))
    return F.map_concat(others, kept)


def with_defaults(metadata: Column, defaults: dict[str, Column]) -> Column:
    """Metadata with defaults for the keys that it doesn't have, null values included."""
    given = F.create_map(*(x for name, c in defaults.items() for x in (F.lit(name), c)))
    missing = F.map_filter(given, lambda k, _: ~F.map_contains_key(metadata, k))
    return F.map_concat(metadata, missing)


def of_quality(rows: DataFrame, tier: str = "high") -> DataFrame:
    """Rows on disk whose quality has this tier; rows without a readable quality have none."""
    return rows.where(F.get_json_object("quality", "$.tier") == tier)


def with_record_ids(records: DataFrame) -> DataFrame:
    """Typed records with their id, of their own source and the part of the subset before the slash."""
    return records.withColumn("id", record_id(F.col("source"), F.split_part("source_subset", F.lit("/"), F.lit(1)), F.col("content_hash")))
