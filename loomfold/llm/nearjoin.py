"""Near-duplicate records by a chosen-path join.

Records are sets of word runs. Each set is sampled to ``WIDTH`` minwise tokens; a run of the join splits the sets
recursively on sampled tokens: the path so far chooses the coordinate, its token the child. Buckets of at most
``limit`` sets are compared by brute force (first by 1-bit sketches, then exactly); larger ones are split again,
each set going to two children per level, so that a pair at the threshold stays together with a probability of 0.91 a
level. The number of runs follows from the target recall; what is reported is exact, what may be missed is below
1 - recall of the pairs at the threshold, and far less above it.

Scale: equal sets are one class from the start, so groups of copies never meet in a bucket. One exchange carries
(path, class, sketch), 32 bytes a row; buckets are runs of the sorted partition and stream through with at most
``limit`` rows in memory. Oversized buckets move on to the next level; those that even the last level can't split
(thousands of sets that are alike) are compared in blocks of ``limit`` rows spread over the cluster. Nothing is
collected to the driver but one count a level; intermediate tables lie in the shared folder.

Defined results. Rows whose messages cannot be decoded (null included) don't take part; a text without words is one
empty run, so such rows are equal to each other; repeated rows are pairs if their keys differ; a null key doesn't
take part; tables without rows give no pairs. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfold.functions.decode import rows_of
from loomfold.llm.bloom import build, may_hold
from loomfold.llm.texts import both, mixed, record_text, runs
from loomfold.session import ship, spread, written

WIDTH = 128
#: Members of a class in a block, where pairs are expanded; rounds of connecting groups.
BLOCK = 1_000
_ROUND = 64

_SEEDS = mixed(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The sampled tokens of sets: WIDTH minwise values each, cut to 16 bits."""
    out = np.empty((len(sets), WIDTH), np.uint16)
    odd = _SEEDS | np.uint64(1)
    for k, s in enumerate(sets):
        low = np.full(WIDTH, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(s), 4096):  # very long texts in pieces
            part = s[at : at + 4096, None] * odd
            low = np.minimum(low, (part ^ (part >> np.uint64(29))).min(axis=0))
        out[k] = mixed(low) >> np.uint64(48)
    return out


def sketches(tokens: np.ndarray) -> np.ndarray:
    """1-bit sketches as two 64-bit integers a set."""
    bits = np.packbits((tokens & 1).astype(np.uint8), axis=1, bitorder="little")
    return bits.view(np.int64)


def sketch_distance(threshold: float) -> int:
    """Differing bits up to which sketches may belong to a pair at the threshold: 4.5 standard deviations beyond the mean."""
    mean = WIDTH * (1 - threshold) / 2
    return int(mean + 4.5 * math.sqrt(mean * (1 + threshold) / 2)) + 1


def _children(path: np.ndarray, tokens: np.ndarray, choice: int) -> np.ndarray:
    """The child of each path: the path chooses a coordinate, the token there the child."""
    h = mixed(path + np.uint64(choice * 2654435761 + 1))
    token = np.take_along_axis(tokens, (h % np.uint64(WIDTH)).astype(np.int64)[:, None], axis=1)[:, 0]
    return mixed(h ^ (token.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def run_count(threshold: float, depth: int, recall: float) -> int:
    """Runs needed so that a pair at the threshold meets at this depth with the target recall."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth)))


def signatures(records: DataFrame, key: str = "rec_no", size: int = 3) -> DataFrame:
    """(key, set_id, tokens): a 128-bit name of the set of runs, and the sampled tokens of the set."""
    ship(records.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            keys, ids, sets = [], [], []
            for no, messages, names in rows_of([batch]):
                if no is not None and (text := record_text(messages, names)) is not None:
                    keys.append(no)
                    sets.append(s := runs(text, size))
                    ids.append(xxhash.xxh3_128_digest(s.tobytes()))
            tokens = [t.tobytes() for t in minwise(sets)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.binary()), pa.array(tokens, pa.binary())], ["key", "set_id", "tokens"])

    return spread(records.select(F.col(key).cast("bigint"), "messages", "tool_names")).mapInArrow(sign, "key bigint, set_id binary, tokens binary")


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per class of equal sets: (rep, set_id, tokens); rep is the smallest key."""
    return signed.groupBy("set_id").agg(F.min("key").alias("rep"), F.first("tokens").alias("tokens"))


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, WIDTH)


def _paths(classes: DataFrame, count: int, depth: int) -> DataFrame:
    """(path, rep, s0, s1): the buckets of each class in all runs at the starting depth."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            tokens, rep = _tokens(batch.column("tokens")), batch.column("rep").to_numpy()
            sketch = sketches(tokens)
            for run in range(count):
                path = np.full(len(rep), run + 1, np.uint64)
                for _ in range(depth):
                    path = _children(path, tokens, 0)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (path.view(np.int64), rep, sketch[:, 0], sketch[:, 1])], ["path", "rep", "s0", "s1"])

    return classes.select("rep", "tokens").mapInArrow(walk, "path bigint, rep bigint, s0 bigint, s1 bigint")


def _deeper(over: DataFrame, classes: DataFrame, branches: int) -> DataFrame:
    """The children of oversized buckets: each set goes to ``branches`` children."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            tokens, rep = _tokens(batch.column("tokens")), batch.column("rep").to_numpy()
            path, sketch = batch.column("path").to_numpy().view(np.uint64), sketches(tokens)
            for choice in range(1, branches + 1):
                child = _children(path, tokens, choice).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (child, rep, sketch[:, 0], sketch[:, 1])], ["path", "rep", "s0", "s1"])

    rows = over.select(F.col("a").alias("rep"), "path").join(_only(classes, build(over.select("a"))), "rep")
    return rows.select("rep", "path", "tokens").mapInArrow(walk, "path bigint, rep bigint, s0 bigint, s1 bigint")


def _only(classes: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(rep, tokens) of the classes that a filter lets pass."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(wanted, batch.column(0))))

    return classes.select("rep", "tokens").mapInArrow(keep, "rep bigint, tokens binary")


def compare_buckets(rows: DataFrame, limit: int, distance: int) -> DataFrame:
    """Brute force within buckets of at most ``limit`` rows: (a, b, path). Rows of larger ones come back as (a, null, path)."""

    def pairs_in(path, rep, sketch):
        """Pairs of the runs of one sorted chunk of whole buckets."""
        starts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
        sizes = np.diff(np.r_[starts, len(path)])
        over = np.repeat(sizes > limit, sizes)
        a_out, b_out = [], []
        for k in np.unique(sizes[(sizes > 1) & (sizes <= limit)]):
            i, j = np.triu_indices(k, 1)
            at = starts[sizes == k]
            step = max(1, 2_000_000 // len(i))
            for s in range(0, len(at), step):
                rows = at[s : s + step, None] + np.arange(k)[None, :]
                w = sketch[rows]
                apart = np.bitwise_count(w[:, i, 0] ^ w[:, j, 0]).astype(np.int16) + np.bitwise_count(w[:, i, 1] ^ w[:, j, 1])
                x, y = np.nonzero(apart <= distance)
                a, b = rep[rows[x, i[y]]], rep[rows[x, j[y]]]
                differ = a != b
                a_out.append(np.minimum(a, b)[differ])
                b_out.append(np.maximum(a, b)[differ])
        a = np.concatenate([*a_out, np.array([], np.int64)])
        b = np.concatenate([*b_out, np.array([], np.int64)])
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
        yield a, b, None
        if over.any():
            yield rep[over], None, path[over]

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hand_out(chunk):
            for a, b, path in pairs_in(*chunk):
                n = len(a)
                if n:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(a, pa.int64()),
                        pa.nulls(n, pa.int64()) if b is None else pa.array(b, pa.int64()),
                        pa.nulls(n, pa.int64()) if path is None else pa.array(path, pa.int64()),
                    ], ["a", "b", "path"])

        held, too_large = None, None  # rows of the bucket that may go on in the next batch; the bucket known to be too large
        for batch in batches:
            if batch.num_rows == 0:
                continue
            path, rep = batch.column("path").to_numpy(), batch.column("rep").to_numpy()
            sketch = np.stack([batch.column("s0").to_numpy(), batch.column("s1").to_numpy()], axis=1).view(np.uint64)
            if too_large is not None and len(more := np.flatnonzero(path == too_large)):
                n = len(more)
                yield pa.RecordBatch.from_arrays([pa.array(rep[more], pa.int64()), pa.nulls(n, pa.int64()), pa.array(path[more], pa.int64())], ["a", "b", "path"])
                path, rep, sketch = path[n:], rep[n:], sketch[n:]
                if len(path) == 0:
                    continue
                too_large = None
            if held is not None:
                path, rep, sketch = np.r_[held[0], path], np.r_[held[1], rep], np.r_[held[2], sketch]
            last = int(np.flatnonzero(path != path[-1])[-1]) + 1 if path[0] != path[-1] else 0
            if len(path) - last > limit:  # the open bucket is too large already: nothing of it is held
                yield from hand_out((path, rep, sketch))
                held, too_large = None, path[-1]
            else:
                if last:
                    yield from hand_out((path[:last], rep[:last], sketch[:last]))
                held = path[last:], rep[last:], sketch[last:]
        if held is not None:
            yield from hand_out(held)

    rows = rows.repartition("path").sortWithinPartitions("path")
    return rows.mapInArrow(brute, "a bigint, b bigint, path bigint")


def _blocks(over: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """Buckets that no level split, in cells of two blocks of about limit / 2 rows: every pair meets in a cell."""
    sizes = over.groupBy("path").agg(F.ceil(F.count("*") * 4 / limit).cast("int").alias("n_blocks"))
    rows = over.select("path", F.col("a").alias("rep")).distinct().join(sizes, "path")
    own = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int"))
    cells = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    cells = cells.select(F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("path"), "rep")
    return _with_sketch(cells, classes)


def _with_sketch(rows: DataFrame, classes: DataFrame) -> DataFrame:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sketch = sketches(_tokens(batch.column("tokens")))
                yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("rep"), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])], ["path", "rep", "s0", "s1"])

    joined = rows.join(classes.select("rep", "tokens"), "rep").select("path", "rep", "tokens")
    return joined.mapInArrow(walk, "path bigint, rep bigint, s0 bigint, s1 bigint")


def candidates(classes: DataFrame, threshold: float, recall: float = 0.9999, depth: int = 2, limit: int = 256, levels: int = 8) -> DataFrame:
    """Distinct pairs (a, b) of classes that met in a bucket and whose sketches agree well enough."""
    distance = sketch_distance(threshold)
    rows = _paths(classes, run_count(threshold, depth, recall), depth)
    found = []
    for _ in range(levels):
        table = written(compare_buckets(rows, limit, distance), "buckets")
        found.append(table.where("b IS NOT NULL").select("a", "b"))
        over = table.where("b IS NULL").select("a", "path")
        if over.isEmpty():
            break
        rows = _deeper(over, classes, 2)
    else:
        cells = _blocks(over, classes, limit)
        found.append(written(compare_buckets(cells, 1 << 30, distance), "blocks").where("b IS NOT NULL").select("a", "b"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.distinct()


def _sets(records: DataFrame, key: str, size: int, wanted: np.ndarray) -> DataFrame:
    """(key, runs): the runs of wanted records as the bytes of a sorted array of 64-bit hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = [], []
            batch = batch.filter(pa.array(may_hold(wanted, batch.column(0))))
            for no, messages, names in rows_of([batch]):
                if (text := record_text(messages, names)) is not None:
                    keys.append(no)
                    sets.append(runs(text, size).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "runs"])

    return spread(records.select(F.col(key).cast("bigint"), "messages", "tool_names")).mapInArrow(cut, "key bigint, runs binary")


def likeness(a: pa.Array, b: pa.Array) -> pa.Array:
    """Common runs and runs in either, of batches of two sets."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        n = both(x, y)
        out.append({"common": n, "either": len(x) + len(y) - n})
    return pa.array(out, pa.struct([("common", pa.int32()), ("either", pa.int32())]))


def verified(pairs: DataFrame, records: DataFrame, tenths: int, key: str = "rec_no", size: int = 3) -> DataFrame:
    """The pairs (a, b, common, either) with 10 x common >= tenths x either, counted on the whole texts."""
    sets = _sets(records, key, size, build(pairs.select(F.explode(F.array("a", "b")))))
    with_a = pairs.join(sets.select(F.col("key").alias("a"), F.col("runs").alias("runs_a")), "a")
    with_b = with_a.join(sets.select(F.col("key").alias("b"), F.col("runs").alias("runs_b")), "b")
    counted = with_b.select("a", "b", F.arrow_udf(likeness, "struct<common:int,either:int>")("runs_a", "runs_b").alias("n"))
    return counted.select("a", "b", "n.common", "n.either").where(F.col("common") * 10 >= F.col("either") * tenths)


def near_classes(records: DataFrame, tenths: int = 8, key: str = "rec_no", size: int = 5, recall: float = 0.9999, limit: int = 256) -> tuple[DataFrame, DataFrame]:
    """The near-duplicate structure of records: (membership (key, rep), links (a, b, common, either) between classes).

    Classes are records with equal sets of runs, named by their smallest key. Copies aren't expanded into pairs.
    """
    signed = written(signatures(records, key, size), "signatures")
    classes = written(classes_of(signed), "classes")
    pairs = written(candidates(classes, tenths / 10, recall, limit=limit), "candidates")
    links = verified(pairs, records, tenths, key, size)
    named = classes.select("set_id", "rep")
    return signed.select("key", "set_id").join(named, "set_id").select("key", "rep"), links


def near_pairs(records: DataFrame, tenths: int = 8, key: str = "rec_no", size: int = 5, recall: float = 0.9999) -> DataFrame:
    """All pairs (rec_a < rec_b) of records with a likeness of at least tenths / 10, copies included.

    Where all pairs are asked for, k copies are k * (k - 1) / 2 rows; ``near_classes`` has them without.
    """
    members, links = near_classes(records, tenths, key, size, recall)
    return expanded(written(members, "members"), links)


def expanded(members: DataFrame, links: DataFrame, block: int = BLOCK) -> DataFrame:
    """The pairs (rec_a, rec_b) of members (key, rep) of one class or of linked classes.

    Classes of more than ``block`` members are cut into blocks, and pairs of blocks are joined: no task gets more than
    the pairs of two blocks of one class at a time, however large a class is.
    """
    large = members.groupBy("rep").agg(F.count("*").alias("n")).where(F.col("n") > block).select("rep", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    counted = members.join(large, "rep", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = counted.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    a = placed.select(F.col("key").alias("key_a"), "rep", "block", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("other"))
    b = placed.select(F.col("key").alias("key_b"), "rep", F.col("block").alias("other"))
    # within a class: a block with itself and those behind
    equal = a.join(b, ["rep", "other"]).where((F.col("block") < F.col("other")) | (F.col("key_a") < F.col("key_b"))).select("key_a", "key_b")
    blocks_of = lambda side: large.select(F.col("rep").alias(side), F.col("blocks").alias(f"blocks_{side}"))
    each = lambda side: F.explode(F.sequence(F.lit(0), F.coalesce(f"blocks_{side}", F.lit(1)) - 1)).alias(f"block_{side}")
    sized = links.select("a", "b").join(blocks_of("a"), "a", "left").join(blocks_of("b"), "b", "left")
    cells = sized.select("a", "b", each("a"), "blocks_b").select("a", "b", "block_a", each("b"))
    side = lambda x: placed.select(F.col("rep").alias(x), F.col("block").alias(f"block_{x}"), F.col("key").alias(f"key_{x}"))
    near = cells.join(side("a"), ["a", "block_a"]).join(side("b"), ["b", "block_b"]).select("key_a", "key_b")
    return equal.union(near).select(F.least("key_a", "key_b").alias("rec_a"), F.greatest("key_a", "key_b").alias("rec_b"))


def components(members: DataFrame, links: DataFrame) -> DataFrame:
    """(key, group_no): the connected groups of near-duplicates, named by their smallest key.

    Large-star and small-star rounds on the links between classes until no edge changes; each round is a written
    table, and only a count per round reaches the driver.
    """
    edges = links.select("a", "b").where("a <> b")
    edges = written(edges, "edges")
    for _ in range(_ROUND):
        both_ways = edges.union(edges.select("b", "a")).toDF("x", "y")
        least = both_ways.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both_ways.join(least, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        toward = large.select(F.greatest("u", "v").alias("x"), F.least("u", "v").alias("y"))
        low = toward.groupBy("x").agg(F.min("y").alias("m"))
        small = toward.join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v")
        merged = small.union(low.select(F.col("x").alias("u"), F.col("m").alias("v")))
        after = written(merged.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "edges")
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            break
        edges = after
    roots = edges.groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("root"))
    return members.join(roots, "rep", "left").select("key", F.coalesce("root", "rep").alias("group_no"))
