"""Writing shards, reports, catalogs and cards, and their publication, over Spark's file systems."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomfold.sources import files
from loomfold.sources.readers import read_shards

SHARD_ROWS, LEAST_ROWS = 25_000, 50_000


def write_shards(rows: DataFrame, folder: str, shard_rows: int = SHARD_ROWS, mode: str = "overwrite") -> None:
    """Parquet files of at most so many rows. Overwriting leaves no files of an earlier run."""
    rows.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", shard_rows).parquet(folder)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    files.write_text(spark, path, json.dumps(report, indent=2, ensure_ascii=False))


def read_report(spark: SparkSession, path: str) -> dict | None:
    """The report of a run, or None where it has none."""
    return json.loads(files.read_text(spark, path)) if files.exists(spark, path) else None


def may_publish(report: dict | None, least: int = LEAST_ROWS) -> bool:
    """Whether a run is complete and large enough to be published."""
    return bool(report) and report.get("total_written", 0) >= least


def publish(spark: SparkSession, out_dir: str, target: str, card: str, private: bool = True, dry_run: bool = True) -> str:
    """Put shards, card and report into a target folder, replacing its shards; dry_run only tells and writes the card here.

    The shards are copied by the executors into a new folder beside the old one, which is replaced when all are there:
    a failure on the way leaves what was published before. Whether it is private is told in ``_visibility.json``.
    """
    out_dir, target = out_dir.rstrip("/"), str(target).rstrip("/")
    files.write_text(spark, f"{out_dir}/README.md", card)
    report = read_report(spark, f"{out_dir}/_report.json")
    rows = (report or {}).get("total_written", 0)
    if dry_run:
        return f"dry run: {rows} rows and a card would go to {target} ({'private' if private else 'public'})"
    write_shards(read_shards(spark, f"{out_dir}/data"), f"{target}/data.new")
    files.replace(spark, f"{target}/data.new", f"{target}/data")
    files.write_text(spark, f"{target}/README.md", card)
    files.write_text(spark, f"{target}/_visibility.json", json.dumps({"private": private}))
    if report is not None:
        write_report(spark, report, f"{target}/_report.json")
    return f"published {rows} rows to {target}"


def publish_when_done(
    spark: SparkSession, running: Callable[[], bool], out_dir: str, target: str, card_of: Callable[[dict], str], least: int = LEAST_ROWS, every: float = 60.0, private: bool = True,
) -> str | None:
    """Wait while a run goes on, then publish it; None if it left no report or fewer rows than ``least``."""
    while running():
        time.sleep(every)
    report = read_report(spark, f"{out_dir.rstrip('/')}/_report.json")
    if not may_publish(report, least):
        return None
    return publish(spark, out_dir, target, card_of(report), private, dry_run=False)
