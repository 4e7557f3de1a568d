"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Naive times are carried as TIMESTAMP_NTZ and converted explicitly.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows here are costly in CPU: small inputs keep all cores, large ones are unaffected.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot never compiles methods above this size: wide projections run twice as fast when
    # they leave whole-stage code instead of being interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Removes the shuffle files of a statement at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or the checkpoint folder the
    application has set.

    Only a local master without either falls back to a folder on this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="skytrace-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/skytrace/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and cut its lineage (survives the loss of executors)."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: nothing reads them once it is written, and
    otherwise they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: columnar, so readers prune columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def packed(df: DataFrame, label: str) -> DataFrame:
    """``written`` with less on disk: by zstd, and without shuffle files left. For whole tables of
    packets."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.parquet(path)
