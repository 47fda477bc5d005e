"""Snapshot choice and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, column: str = "snapshot") -> DataFrame:
    """Rows of the greatest snapshot name. As a scalar subquery it prunes partitions."""
    return df.where(F.col(column) == df.select(F.max(column)).scalar())


def pinned_snapshot(df: DataFrame, snapshot: str, column: str = "snapshot") -> DataFrame:
    return df.where(F.col(column) == snapshot)


def keep_latest(df: DataFrame, n: int = 1, column: str = "snapshot") -> DataFrame:
    """Rows of the newest ``n`` snapshots."""
    newest = df.select(column).distinct().orderBy(F.desc(column)).limit(n)
    return df.join(F.broadcast(newest) if n <= 10_000 else newest, column, "left_semi")


def snapshots(df: DataFrame, column: str = "snapshot") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("total_comments"))
