"""Structured Streaming: exact greedy deduplication across micro-batches, and windowed counts of late events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfold.operators.dedup import resolve
from loomfold.sources import files


class KeptTokens:
    """The tokens of all rows kept so far, one folder per micro-batch, so a repeated batch replaces what it wrote."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, before: int) -> DataFrame | None:
        """Tokens of the batches before a number; None if there are none."""
        if not files.exists(self.spark, self.path):
            return None
        found = self.spark.read.option("basePath", self.path).schema("ord bigint, layer string, token string, batch int").parquet(self.path)
        return found.where(F.col("batch") < before)

    def process(self, tokens: DataFrame, number: int) -> DataFrame:
        """(ord, reason) of a batch of tokens (ord, layer, token); the tokens of its kept rows are added."""
        known = self.table(number)
        # only tokens that the batch has can block it: the others stay out of the rounds
        own = tokens.select("token").distinct()
        decided = resolve(tokens, None if known is None else known.join(own, "token", "left_semi"))
        kept = tokens.join(decided.where("reason IS NULL").select("ord"), "ord", "left_semi")
        kept.write.mode("overwrite").parquet(f"{self.path}/batch={number}")
        return decided


def stream_dedup(rows: DataFrame, make_tokens, kept: KeptTokens, sink: str, checkpoint: str):
    """A query that decides the rows of a stream against all rows before, by order of arrival; results go to ``sink``.

    The folder of a batch is overwritten when the batch is repeated, so results are exact after a restart.
    """

    def handle(batch: DataFrame, number: int) -> None:
        kept.process(make_tokens(batch), number).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def windowed_counts(events: DataFrame, late: str = "10 minutes", window: str = "5 minutes", time: str = "ts", key: str = "event_type") -> DataFrame:
    """(start, key, n, total) of event-time windows; events later than the watermark are dropped."""
    counted = events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("start"), key, "n", "total")


def first_seen(events: DataFrame, keys: list[str], time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Events without repeats of keys within the watermark: exact keys only, with bounded state."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
