"""Deduplicating new batches against all history by a persistent table of word runs.

The table holds the hashes of the runs of each accepted record, with its identity and a sketch of 128 bits, and beside it
one row per class of equal sets of runs. A batch is looked up by its own runs, likeness is counted on the runs, and its
accepted rows are appended: the texts of history are read once, when they are accepted.

A pair at the threshold has at least ``tenths`` tenths of the runs of either text in common. So each new text looks up
only as many of its rarest runs that the others alone couldn't be enough, and a text of history whose runs the batch
has too few of is left out: both bounds hold for every pair, whatever the lengths and edits, and texts that share
common phrases alone don't meet. Nothing is capped. Pairs that met are compared by their sketches before their runs
are fetched, then counted exactly.

The accepted rows are the greedy choice by ascending number: rounds accept every row that is the first undecided
among its id, its class and the linked classes, then reject what these block. Copies are one class and one id is one
group, so no group is expanded into pairs, and rounds work on the rows left over only.

Defined results. Messages that cannot be decoded: the row counts by id only. Null or blank ids match nothing. A text
without words is one empty run. Repeated keys count as rows that come together: both stay or go. An empty batch or
history gives no or no blocked rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomfold.functions.decode import rows_of
from loomfold.llm.bloom import build, may_hold
from loomfold.llm.nearjoin import minwise, sketch_distance, sketches
from loomfold.llm.texts import both, record_text, runs
from loomfold.session import shared_dir, ship, spread, written

TOKEN_SHIFT = 24  # runs are looked up by 40 bits; those that agree in them may meet, but are counted whole
ROWS = "key bigint, tail string, set_id binary, runs binary, s0 bigint, s1 bigint"
CLASSES = "set_id binary, rep bigint"

def id_tail(column: str = "id"):
    """The last 16 characters of an id, outer spaces and letter case ignored; null where there are none."""
    tail = F.substring(F.lower(F.regexp_replace(column, r"^\s+|\s+$", "")), -16, 16)
    return F.when(tail != "", tail)


def _identities(rows: DataFrame, key: str, size: int) -> DataFrame:
    """(key, tail, set_id, runs, s0, s1) of rows with id, messages and tool_names; nulls where messages can't be decoded.

    runs are the bytes of a sorted array of 64-bit hashes.
    """
    ship(rows.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kept, sets = [], [], []
            for messages, names in rows_of([batch.select(["messages", "tool_names"])]):
                text = record_text(messages, names)
                sets.append(own := np.array([], np.uint64) if text is None else runs(text, size))
                ids.append(None if text is None else xxhash.xxh3_128_digest(own.tobytes()))
                kept.append(None if text is None else own.tobytes())
            sketch = sketches(minwise(sets))
            columns = [pa.array(ids, pa.binary()), pa.array(kept, pa.binary()), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("tail"), *columns], ["key", "tail", "set_id", "runs", "s0", "s1"])

    plain = spread(rows.select(F.col(key).cast("bigint").alias("key"), id_tail().alias("tail"), "messages", "tool_names"))
    return plain.mapInArrow(sign, ROWS)


def _classes(signed: DataFrame) -> DataFrame:
    """(set_id, rep): the classes of equal sets of runs, named by their smallest key."""
    return signed.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("key").alias("rep"))


def _wanted(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose first column a filter of the keys lets pass; a filter of fixed size may leave some others."""
    wanted = build(keys)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(wanted, batch.column(0))))

    return rows.mapInArrow(keep, rows.schema)


def _first_rows(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows that stand for their classes; some copies may be left, which do no harm."""
    return _wanted(signed.where("set_id IS NOT NULL"), classes.select("rep"))


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all rows in a row, where each row begins and the last ends) of a column of runs."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64) // 8
    whole = np.frombuffer(b"".join(x for x in column.to_pylist() if x is not None), np.uint64)
    return (whole >> np.uint64(TOKEN_SHIFT)).view(np.int64), np.r_[0, np.cumsum(sizes)]


def _exploded(rows: DataFrame, wanted: np.ndarray | None = None, tenths: int = 0) -> DataFrame:
    """(key, runs, token) of rows (key, runs), runs being their number.

    With a filter only the tokens it lets pass, and only of rows that keep enough of them for a near-duplicate.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, ends = _tokens(batch.column("runs"))
            sizes = np.diff(ends)
            row = np.repeat(np.arange(len(sizes)), sizes)
            if wanted is not None:
                passed = may_hold(wanted, pa.array(tokens)) if len(tokens) else np.array([], bool)
                enough = np.bincount(row[passed], minlength=len(sizes)) >= _least(sizes, tenths)
                passed &= enough[row]
                tokens, row = tokens[passed], row[passed]
            keys = batch.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(keys[row], pa.int64()), pa.array(sizes[row].astype(np.int32)), pa.array(tokens)], ["key", "runs", "token"])

    return rows.select("key", "runs").mapInArrow(explode, "key bigint, runs int, token bigint")


def _least(runs, tenths: int):
    """The runs of a text that a near-duplicate has at the least: tenths of them, rounded up."""
    return (runs * tenths + 9) // 10


def _compare(a: pa.Array, b: pa.Array) -> pa.Array:
    """Common and all runs, of batches of two sets."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        common = both(x, y)
        out.append({"common": common, "either": len(x) + len(y) - common})
    return pa.array(out, pa.struct([("common", pa.int32()), ("either", pa.int32())]))


class History:
    """Everything accepted so far, as two tables in a folder: rows (``ROWS``) and classes of equal sets (``CLASSES``)."""

    def __init__(self, spark: SparkSession, path: str | None = None, key: str = "rec_no", size: int = 3, tenths: int = 7):
        self.spark, self.key, self.size, self.tenths = spark, key, size, tenths
        self.path = path or f"{shared_dir(spark).rstrip('/')}/history-{uuid.uuid4().hex}"

    def start(self, rows: DataFrame) -> History:
        """Accept all rows as they are."""
        self._append(_identities(rows, self.key, self.size), "rows")
        self._append(_classes(self.table()), "classes")
        return self

    def _append(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/{name}")

    def table(self) -> DataFrame:
        return self.spark.read.schema(ROWS).parquet(f"{self.path}/rows")

    def classes(self) -> DataFrame:
        return self.spark.read.schema(CLASSES).parquet(f"{self.path}/classes")

    def _links(self, new: DataFrame) -> DataFrame:
        """(a, b, old): classes a of the batch and classes b of history (old) or of the batch that are near-duplicates."""
        old = _first_rows(self.table().select("key", "set_id", "runs", "s0", "s1"), self.classes())
        # one column holds the class and whether it is old: 2 x key + 1 or 2 x key
        own = F.col("key") * 2
        mine = _exploded(new)
        # texts of history of whose runs the batch surely has too few stay out of the shuffle
        met_runs = _exploded(old, build(mine.select("token")), self.tenths)
        everything = met_runs.select("token", (own + 1).alias("b")).union(mine.select("token", own)).repartition("token")
        frequency = everything.groupBy("token").count().where("count > 1")
        rarest = Window.partitionBy("a").orderBy("count", "token")
        ranked = mine.withColumnRenamed("key", "a").join(frequency, "token", "left").fillna(1, ["count"]).withColumn("place", F.row_number().over(rarest))
        # without its rarest runs up to this place a text has one too few; runs nobody else has find nobody
        least = F.expr(f"(runs * {self.tenths} + 9) div 10")
        lookup = ranked.where((F.col("place") <= F.col("runs") - least + 1) & (F.col("count") > 1)).select("token", "a")
        met = lookup.join(everything, "token").where("b <> a * 2").select("a", "b").distinct()
        sketch = old.select((own + 1).alias("b"), "s0", "s1").union(new.select(own, "s0", "s1"))
        seen = met.join(sketch, "b").join(new.select(F.col("key").alias("a"), F.col("s0").alias("t0"), F.col("s1").alias("t1")), "a")
        apart = F.bit_count(F.col("s0").bitwiseXOR(F.col("t0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("t1")))
        alike = seen.where(apart <= sketch_distance(self.tenths / 10))
        pairs = written(alike.select("a", F.shiftright("b", 1).alias("b"), (F.col("b") % 2 != 0).alias("old")), "met")
        runs_of = lambda rows, keys, side: _wanted(rows.select("key", "runs"), keys).toDF(side, f"runs_{side}")
        b_runs = runs_of(old, pairs.where("old").select("b"), "b").withColumn("old", F.lit(True))
        b_runs = b_runs.unionByName(runs_of(new, pairs.where("NOT old").select("b"), "b").withColumn("old", F.lit(False)))
        compare = F.arrow_udf(_compare, "struct<common:int,either:int>")
        told = pairs.join(runs_of(new, pairs.select("a"), "a"), "a").join(b_runs, ["b", "old"]).select("a", "b", "old", compare("runs_a", "runs_b").alias("n"))
        return told.where(F.col("n.common") * 10 >= F.col("n.either") * self.tenths).select("a", "b", "old")

    def admit(self, batch: DataFrame, append: bool = True) -> DataFrame:
        """The rejected rows (key) of a batch; the others are accepted and, unless told otherwise, appended."""
        signed = written(_identities(batch, self.key, self.size), "identities")
        old = self.table()
        known = self.classes().select("set_id")
        named = written(_classes(signed).join(known, "set_id", "left_anti"), "classes")  # equal texts in history: rejected below
        links = written(self._links(_first_rows(signed.select("key", "set_id", "runs", "s0", "s1"), named)), "links")
        blocked_classes = links.where("old").select(F.col("a").alias("rep")).distinct()
        rows = (
            signed.select("key", "tail", "set_id")
            .join(old.where("tail IS NOT NULL").select("tail").distinct(), "tail", "left_anti")
            .join(named, "set_id", "left")
            .where("rep IS NOT NULL OR set_id IS NULL")
            .join(blocked_classes, "rep", "left_anti")
            .select("key", "tail", "rep")
        )
        accepted = _greedy(written(rows, "undecided"), links.where("NOT old").select("a", "b"))
        if append:
            taken = written(signed.join(accepted.select("key"), "key", "left_semi"), "taken")
            self._append(taken, "rows")
            self._append(_classes(taken), "classes")
        return signed.select("key").join(accepted.select("key"), "key", "left_anti")


def _greedy(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The accepted rows (key, tail, rep): by ascending key each row that no accepted one shares an id, class or link with."""
    links = written(links.union(links.select("b", "a")).distinct(), "links")
    accepted = None
    while not rows.isEmpty():
        by_id = rows.groupBy("tail").agg(F.min("key").alias("first_id"))
        by_class = rows.where("rep IS NOT NULL").groupBy("rep").agg(F.min("key").alias("first_class"))
        by_link = links.join(by_class, links.b == by_class.rep).groupBy("a").agg(F.min("first_class").alias("first_link")).withColumnRenamed("a", "rep")
        seen = rows.join(by_id, "tail", "left").join(by_class, "rep", "left").join(by_link, "rep", "left")
        own = F.col("key")
        first = (
            (F.coalesce("first_id", own) == own)
            & (F.coalesce("first_class", own) == own)
            & (F.coalesce("first_link", own + 1) > own)
        )
        taken = written(seen.where(first).select("key", "tail", "rep"), "accepted")
        accepted = taken if accepted is None else accepted.union(taken)
        blocked = links.join(taken, links.b == taken.rep, "left_semi").select(F.col("a").alias("rep")).union(taken.where("rep IS NOT NULL").select("rep")).distinct()
        left = rows.join(taken.where("tail IS NOT NULL").select("tail").distinct(), "tail", "left_anti").join(blocked, "rep", "left_anti")
        rows = written(left.join(taken.select("key"), "key", "left_anti").select("key", "tail", "rep"), "undecided")
    return rows if accepted is None else accepted
