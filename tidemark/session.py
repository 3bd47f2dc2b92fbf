"""Session building and the few run-time helpers that look at the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidemark", cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local[..] master, where driver and executors share one machine, falls back
    to a fresh temporary folder.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    sc.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, for loops that would grow the plan."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes for a plain scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *key: str, size_of: DataFrame | None = None) -> DataFrame:
    """Spread a small input over all cores before CPU-heavy text work.

    A small Parquet file has one row group and would be read by one task. Inputs that
    fill the cluster anyway are returned as they are, so no shuffle is added there.
    The split is by hash of ``key``, so a recomputed task sees the same rows again; the key
    has to be unique per row, as a common value would put its rows into one task. For a stream, ``size_of`` is the stored table it reads.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if cores > 1 and estimated_bytes(df if size_of is None else size_of) < cores * SPLIT_BYTES:
        return df.repartition(cores, *key)
    return df


SPLIT_BYTES = 32 * 1024 * 1024  # below this per core the scan alone cannot keep the cores busy
