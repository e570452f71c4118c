"""Small files and folders over Spark's file systems: reports and cards lie where the shards lie, on a disk or in a store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    where = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A text as a file, replacing one that is there."""
    system, where = _at(spark, path)
    out = system.create(where, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    system, where = _at(spark, path)
    given = system.open(where)
    try:
        return bytes(given.readAllBytes()).decode("utf-8")
    finally:
        given.close()


def replace(spark: SparkSession, new: str, old: str) -> None:
    """Put a finished folder into the place of an old one. The old one is moved aside first and comes back if that fails."""
    system, source = _at(spark, new)
    _, target = _at(spark, old)
    _, aside = _at(spark, f"{old}.before")
    system.delete(aside, True)
    had = system.exists(target)
    if had and not system.rename(target, aside):
        raise OSError(f"can't move {old} aside")
    if not system.rename(source, target):
        if had:
            system.rename(aside, target)
        raise OSError(f"can't move {new} to {old}")
    system.delete(aside, True)
