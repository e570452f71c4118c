"""Reading rows of sources and canonical shards, and the hashes of a reference set."""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfold.functions.decode import rows_of
from loomfold.functions.hashing import content_hash
from loomfold.schema import ON_DISK
from loomfold.session import ship, spread

#: Bits of the place of a row in its file, of the number of a file, and files of a subset whose numbers are broadcast.
ROW_BITS, FILE_BITS, MAX_FILES = 36, 27, 1_000_000
FORMATS = {".parquet": "parquet", ".json": "json", ".jsonl": "json", ".csv": "csv", ".orc": "orc"}


def read_rows(spark: SparkSession, path: str, kind: str | None = None, skip_corrupt: bool = False) -> DataFrame:
    """Rows of a local or shared path; the kind is told by the ending unless given.

    skip_corrupt goes on with the rows that can be read where files are broken, as near as a distributed read comes to
    keeping the rows before a failure.
    """
    kind = kind or FORMATS.get(Path(path.rstrip("/")).suffix, "parquet")
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return (reader.option("header", "true") if kind == "csv" else reader).format(kind).load(path)


def subset_path(root: str, hf_id: str, config: str, split: str, ending: str = ".parquet") -> str:
    """Where the rows of a subset lie below a root folder."""
    return f"{root.rstrip('/')}/{hf_id}/{config}/{split}{ending}"


def open_subset(spark: SparkSession, root: str, source, subset, skip_corrupt: bool = False) -> DataFrame:
    """The rows of a subset, in the first format of ``FORMATS`` in which it is there."""
    tried: list[str] = []
    for ending in FORMATS:
        try:
            return read_rows(spark, subset_path(root, source.hf_id, subset.config, subset.split, ending), skip_corrupt=skip_corrupt)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            tried.append(ending)
    raise FileNotFoundError(f"{subset_path(root, source.hf_id, subset.config, subset.split, '')} with any of {', '.join(tried)}")


def open_subsets(spark: SparkSession, root: str, source, errors: dict[str, str], skip_corrupt: bool = False) -> list[tuple[object, DataFrame]]:
    """(subset, rows) of a source; a subset that can't be opened is told in ``errors`` and left out."""
    opened = []
    for subset in source.subsets:
        try:
            opened.append((subset, open_subset(spark, root, source, subset, skip_corrupt)))
        except Exception as e:  # noqa: BLE001 - the other subsets go on
            errors[f"{source.key}/{subset.config}/{subset.split}"] = str(e)[:300]
    return opened


def in_file_order(rows: DataFrame, first_file: int = 0) -> tuple[DataFrame, int]:
    """(rows with ``_row`` and ``_in_file``, number behind the last file): a unique order by the name of the file, then by place in it.

    ``_in_file`` is the number of a row in its file where the format tells it, else 0. ``_row`` is the number of the file, counted from ``first_file``, times 2 ** 36 plus the place of the row in the
    file, whatever partitions the scan makes of the files. Parquet tells the place; in other formats rows are counted
    from the byte at which their part of the file begins, which no part before reaches.
    """
    spark = rows.sparkSession
    files = sorted(rows.inputFiles())
    if len(files) > MAX_FILES or first_file + len(files) >= 1 << FILE_BITS:
        raise ValueError(f"more than {MAX_FILES} files in a subset: give a column of order")
    numbers = F.broadcast(spark.createDataFrame([(re.sub("^file:/+", "file:/", f), first_file + i) for i, f in enumerate(files)], "_file string, _file_no bigint"))  # MAX_FILES at most
    is_parquet = all(f.rsplit("/", 1)[-1].endswith(".parquet") for f in files)
    place = F.col("_metadata.row_index") if is_parquet else F.col("_metadata.file_block_start")
    path = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    placed = rows.select("*", path.alias("_file"), place.alias("_in_file")).join(numbers, "_file", "left")
    unknown = F.raise_error(F.concat(F.lit("a file that wasn't listed: "), "_file")).cast("bigint")
    placed = placed.withColumn("_file_no", F.coalesce("_file_no", unknown))
    if not is_parquet:
        placed = _counted(placed)
    numbered = placed.withColumn("_row", F.shiftleft("_file_no", ROW_BITS) + F.col("_in_file")).drop("_file", "_file_no")
    return numbered if is_parquet else numbered.withColumn("_in_file", F.lit(0)), first_file + len(files)


def _counted(placed: DataFrame) -> DataFrame:
    """``_in_file`` with the rows of each part of a file counted on from where it begins."""

    def count(batches):
        before, n = None, 0
        for batch in batches:
            keys = list(zip(batch.column("_file_no").to_pylist(), batch.column("_in_file").to_pylist()))
            out = []
            for key in keys:
                n = n + 1 if key == before else 0
                before = key
                out.append(key[1] + n)
            at = batch.schema.get_field_index("_in_file")
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, pa.int64()))

    return placed.mapInArrow(count, placed.schema)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical rows of written shards."""
    return spark.read.schema(ON_DISK).parquet(folder)


def row_hashes(rows: DataFrame) -> DataFrame:
    """(hash): distinct content hashes of canonical rows on disk; rows that can't be decoded are left out."""
    ship(rows.sparkSession)

    def tell(batches):
        for batch in batches:
            found = []
            for messages, names in rows_of([batch]):
                try:
                    decoded = json.loads(messages or "null")
                    if isinstance(decoded, list):
                        found.append(content_hash(decoded, [n for n in names or () if n is not None]))
                except (AttributeError, KeyError, TypeError, ValueError, RecursionError):
                    continue
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["hash"])

    return spread(rows.select("messages", "tool_names")).mapInArrow(tell, "hash string").distinct()


def reference_hashes(spark: SparkSession, rows: DataFrame, cache: str | None = None, name: str = "", limit: int | None = None) -> DataFrame:
    """Hashes of a reference set, read from a cache that belongs to its name and limit if there is one."""
    limited = rows.limit(limit) if limit else rows
    if cache is None:
        return row_hashes(limited)
    path = f"{cache.rstrip('/')}/{hashlib.md5(f'{name}|{limit or 0}'.encode()).hexdigest()}"
    try:
        return spark.read.schema("hash string").text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    row_hashes(limited).orderBy("hash").write.mode("errorifexists").text(path)
    return spark.read.schema("hash string").text(path)
