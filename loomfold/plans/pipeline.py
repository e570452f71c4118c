"""A run: sources -> normalize -> validate -> deduplicate -> score -> shards and report."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfold.functions.hashing import BAND_ROWS, BANDS, banding
from loomfold.functions.text import record_id
from loomfold.operators import dedup, quality, report, validate
from loomfold.operators.normalize import normalize, to_rows
from loomfold.sources.readers import in_file_order, open_subsets
from loomfold.sources.registry import Registry, Source
from loomfold.sources.sinks import write_report, write_shards
from loomfold.session import written

#: The threshold of near-duplicates unless the registry has another.
NEAR_THRESHOLD = 0.85
#: Bits of the order that a column gives within a subset.
ORDER_BITS = 43


def ordered(rows: DataFrame, order: str | None, position: int, first_file: int) -> tuple[DataFrame, int]:
    """(rows with ``_row``, number behind the last file): a unique order over all subsets, by subset, then within it.

    Within a subset the order column counts if given, else the file by its name and the place in the file. Values of the
    column outside of 0 to 2 ** 43 fail the job: they would collide with other subsets.
    """
    if order is None:
        return in_file_order(rows, first_file)
    given = F.col(order).cast("bigint")
    inside = F.when(given.between(0, (1 << ORDER_BITS) - 1), given).otherwise(F.raise_error(F.concat(F.lit("order outside of its range: "), F.coalesce(given.cast("string"), F.lit("null")))).cast("bigint"))
    return rows.withColumns({"_row": inside + F.lit(position << ORDER_BITS), "_in_file": F.lit(0)}), first_file


def normalized(
    rows: DataFrame, source: Source, subset, position: int = 0, cap: int | None = None, order: str | None = None, first_file: int = 0, banding: tuple[int, int] = (BANDS, BAND_ROWS), dropped: bool = False,
) -> tuple[DataFrame, int]:
    """(canonical records of one subset, number behind its last file), their order behind that of the subsets before.

    The cap counts raw rows; rows whose place in their own file is beyond it aren't sorted for it.
    """
    numbered, files = ordered(rows, order, position, first_file)
    if cap:
        numbered = numbered.where(F.col("_in_file") < cap) if order is None else numbered
        numbered = numbered.orderBy("_row").limit(cap)
    defaults = {"hf_id": source.hf_id, "license": source.license, "dedup_group": source.dedup_group}
    name = f"{subset.config}/{subset.split}"
    records = normalize(numbered.drop("_in_file"), source.normalizer, source.key, name, source.cfg, "_row", source.ext, source.provenance, defaults, banding, dropped)
    tagged = records.withColumns({"config": F.lit(subset.config), "tier": F.lit(source.tier), "dedup_group": F.lit(source.dedup_group)})
    return tagged.withColumn("id", record_id(F.lit(source.key), F.lit(subset.config), F.col("content_hash"))), files


def run(
    spark: SparkSession, registry: Registry, root: str, out_dir: str, tiers: list[str] | None = None, keys: list[str] | None = None,
    against: DataFrame | None = None, near: bool | None = None, limit: int | None = None, order: str | None = None, scope: str | None = None, skip_corrupt: bool = False,
) -> dict:
    """Ingest the selected sources from below ``root`` into shards and a report, which is also given back.

    limit bounds the rows of each subset, 0 and None don't; near overrides the default of the registry if given, whose
    near_threshold divides the signatures into bands. scope="dedup_group" compares rows within their group only; by
    default all rows are compared. skip_corrupt goes on behind broken files. All counts come from the written tables.
    """
    began = time.time()
    near = registry.defaults.get("near_dedup", True) if near is None else near
    bands = banding(float(registry.defaults.get("near_threshold", NEAR_THRESHOLD)))
    chosen = registry.by_key(keys) if keys else registry.by_tier(tiers)
    errors: dict[str, str] = {}
    parts: list[DataFrame] = []
    files = 0
    for source in chosen:
        for subset, rows in open_subsets(spark, root, source, errors, skip_corrupt):
            caps = [c for c in (subset.max_rows, limit) if c]
            part, files = normalized(rows, source, subset, len(parts), min(caps) if caps else None, order, files, bands, dropped=True)
            parts.append(part)
    if not parts:
        told = {"sources": [s.key for s in chosen], "errors": errors, "total_written": 0, "duration_sec": round(time.time() - began, 1), "by_tier": {}, "by_quality": {}, "filtered": {}, "dedup": {}, "per_source": {s.key: {"seen": 0, "written": 0} for s in chosen}}
        write_report(spark, told, f"{out_dir}/_report.json")
        return told
    checked = written(validate.validated(reduce(DataFrame.unionByName, parts)), "validated")
    unique = written(dedup.deduplicate(checked.where("reason IS NULL"), against, near, scope), "deduplicated")
    kept = written(quality.scored(unique.where("dup_reason IS NULL").withColumnRenamed("tier", "source_tier")), "scored")
    write_shards(to_rows(kept), f"{out_dir}/data")
    counts = lambda df, c: {r[0]: r[1] for r in report.by(df, c).collect()}  # noqa: E731 - a few tiers or sources
    seen, total = counts(checked, "source"), counts(kept, "source")
    told = {
        "sources": [s.key for s in chosen],
        "tiers": sorted({s.tier for s in chosen}),
        "total_written": sum(total.values()),
        "by_tier": counts(kept, "source_tier"),
        "by_quality": counts(kept, "tier"),
        "filtered": {r.reason: r.n for r in report.top_reasons(checked).collect()},
        "dedup": dedup.stats(unique).first().asDict(),
        "per_source": {s.key: {"seen": seen.get(s.key, 0), "written": total.get(s.key, 0)} for s in chosen},
        "errors": errors,
        "duration_sec": round(time.time() - began, 1),
    }
    write_report(spark, told, f"{out_dir}/_report.json")
    return told


def check_source(spark: SparkSession, source: Source, root: str, n_rows: int = 5) -> DataFrame:
    """The first rows of the first subset of a source, normalized and validated."""
    if not source.subsets:
        raise ValueError(f"source {source.key} has no subset")
    errors: dict[str, str] = {}
    opened = open_subsets(spark, root, source, errors)
    if not opened:
        raise ValueError(f"source {source.key} can't be read: {errors}")
    subset, rows = opened[0]
    return validate.validated(normalized(rows, source, subset, cap=n_rows or None)[0])
