"""Partitioning helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barcodeforge.session import ensure_checkpoint_dir

SMALL_INPUT_BYTES = 1 << 30
BROADCAST_BYTES = 16 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df`` (file sizes propagated through the plan); no job runs."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def spread(df: DataFrame, min_partitions: int | None = None, max_bytes: int = SMALL_INPUT_BYTES) -> DataFrame:
    """Give a Python-heavy stage enough tasks when its input is small.

    A small input (one Parquet file, or a shuffle output AQE coalesced into one partition)
    would put all Arrow-UDF work in one task. When the estimated size is at most
    ``max_bytes`` the frame is round-robin repartitioned to the default parallelism (cheap at
    that size; deterministic on retry, since Spark sorts before a round-robin repartition).
    Larger inputs already arrive in many splits and are left alone, so there is no extra
    shuffle at scale.
    """
    if estimated_bytes(df) > max_bytes:
        return df
    return df.repartition(min_partitions or df.sparkSession.sparkContext.defaultParallelism)


def shuffled(df: DataFrame) -> DataFrame:
    """Hint that a join with ``df`` is a shuffle, never a broadcast through the driver. The planner
    takes a frame's size from the compressed files and default column widths; of rows that grow
    with the input (long strings, exploded pieces) that is a small part of the real size."""
    return df.hint("merge")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's shared folder (``spark.checkpoint.dir``), removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Stage boundary: write ``df`` once as Parquet to the session's shared folder
    (``spark.checkpoint.dir``) and read it from there.

    Used where an expensive frame feeds several branches of the next stage (seeds feed the
    statistics and the median pass; search hits feed dedup counts, join-backs and conflict
    sets), so the expensive work runs once and a lost executor recomputes from the last
    boundary only. The folder is removed when the driver ends, in any session.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a small reference table (such as the primer table) whose estimated size
    in bytes is at most ``max_bytes``; no job runs to find out. A larger table is joined as the
    planner sees fit."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df
