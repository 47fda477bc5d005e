"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange below.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "reelgauge", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it, or else one in the warehouse,
    which executors share too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to a table in the shared folder and read them back.

    Cuts the plan's lineage once, survives lost executors, and computes the rows one time.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Re-partition a scan that has fewer splits than the cluster has cores.

    For CPU-heavy text work on few or unsplittable files. A scan with enough splits, as any large
    one has, is returned as it is and costs no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *columns) if df.rdd.getNumPartitions() < cores else df


@cache
def _c_library():
    import ctypes

    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def give_back() -> None:
    """Return freed memory to the system; a worker is kept for later tasks, also of other stages."""
    pa.default_memory_pool().release_unused()
    if _c_library() is not None:
        _c_library().malloc_trim(0)
