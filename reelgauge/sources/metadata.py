"""Selected-video metadata files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelgauge.operators.snapshots import latest_snapshot, pinned_snapshot
from reelgauge.schemas import VIDEO
from reelgauge.sources.landing import read_json, readable


STORED = StructType(
    [*VIDEO.fields, StructField("snapshot", StringType()), StructField("period", StringType())]
)


def write_videos(videos: DataFrame, root: str, snapshot: str, period: str) -> None:
    """Write the selected videos of one run and period as JSON."""
    videos.select(*VIDEO.names).write.mode("overwrite").json(
        f"{root}/snapshot={snapshot}/period={period}"
    )


def read_videos(
    spark: SparkSession, root: str, snapshot: str | None = None, multiline: bool = False
) -> DataFrame:
    """Video metadata of one run, the latest where none is named; undecodable files are skipped."""
    rows = read_json(spark, root, STORED, multiline, partitions=True)
    chosen = pinned_snapshot(rows, snapshot) if snapshot else latest_snapshot(rows)
    return readable(chosen.drop("snapshot", "period")).where(F.col("video_id").isNotNull())
