"""Session helpers: builder for local runs, shipping of the package, durable cuts of lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "loomfold") -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LOOMFOLD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from the checkout. Harmless where it is installed."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    # a join may reuse a partitioning by some of its keys: rows that lie together needn't move again
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, of spark.checkpoint.dir.

    Where it is unset, a local session gets a folder of its own, which goes with the process; on a cluster a folder of
    one machine would lose what the others write, so the setting is asked for.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="loomfold-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder, which survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def spread(df: DataFrame, column: str | None = None, per_core: int = 3) -> DataFrame:
    """Spread rows of a file with few row groups over all cores before work in Python, only if the scan has too few tasks.

    A scan of many files or row groups already has many tasks and stays as it is: no shuffle.
    """
    spark = df.sparkSession
    cores = max(spark.sparkContext.defaultParallelism, 1)
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * per_core, column) if column else df.repartition(cores * per_core)
