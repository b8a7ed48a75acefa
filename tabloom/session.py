"""Session helpers shared by tests, the benchmark and the query catalogue."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; unset, a local master gets a temporary one and a cluster an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tabloom-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent on a local master (tests, a laptop) a temporary folder is used.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def together(*jobs: Callable[[], object], at_once: int = 8) -> list:
    """Run independent driver-side jobs at the same time, at most ``at_once``; the scheduler interleaves their tasks."""
    if len(jobs) < 2 or at_once < 2:
        return [j() for j in jobs]
    with ThreadPool(min(at_once, len(jobs))) as pool:
        spark = SparkSession.getActiveSession()
        own = inheritable_thread_target(spark) if spark else lambda j: j  # job groups and other settings of the caller
        return pool.map(lambda j: j(), [own(j) for j in jobs])


def keep(df: DataFrame) -> DataFrame:
    """Persist an iteratively read frame; lost blocks are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
