"""Choices that depend on the running cluster: shared folders and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}

# A side is broadcast only when it was counted and has at most this many rows.
BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach; the cluster names it in ``spark.checkpoint.dir``."""
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getConf().get("spark.checkpoint.dir")
              or spark.sparkContext.getCheckpointDir())
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _LOCAL.setdefault("folder", tempfile.mkdtemp(prefix="sonde-"))
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage once and read it from there afterwards."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a large intermediate table to the shared folder as Parquet and scan it from there.

    Later steps then read only the columns they need, and lost tasks do not replay the past.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows_per_task: int = 10_000, most: int = 500_000) -> DataFrame:
    """Use all cores for a stored table that its scan reads in too few tasks.

    A table of fewer rows than ``rows_per_task`` per core gets fewer tasks.  A large one gets so many
    that none has over ``most`` rows, as fits keep several hundred bytes a row; it keeps the
    partitions of its scan where these are enough.
    """
    cores, n = df.sparkSession.sparkContext.defaultParallelism, df.count()
    want = max(min(cores, -(-n // rows_per_task)), -(-n // most))
    return df if want <= df.rdd.getNumPartitions() else df.repartition(want)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Checkpoint an aggregated table, count it, and mark it for broadcast when it is small.

    Beyond ``limit`` rows the table comes back without a hint: the join is then a shuffle join
    whose hot keys adaptive execution splits.
    """
    done = checkpointed(df)
    return F.broadcast(done) if done.count() <= limit else done
