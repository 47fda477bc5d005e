"""Report sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.values import report_time

JSON_OPTIONS = {"ignoreNullFields": "false"}


def report_lines(per_video: DataFrame, key: str = "video_key") -> DataFrame:
    """One JSON text per video; NULL fields and non-ASCII text are kept."""
    fields = [c for c in per_video.columns if c != key]
    return per_video.select(key, F.to_json(F.struct(*fields), JSON_OPTIONS).alias("report"))


def report_header(
    per_video: DataFrame,
    moment: Column,
    counted_as: str = "total_videos_analyzed",
    parameters: dict | None = None,
    key: str = "video_key",
) -> DataFrame:
    """Report time and number of videos, with the parameters if given."""
    columns = [
        report_time(moment).alias("analysis_timestamp"),
        F.col("_videos").alias(counted_as),
    ]
    if parameters:
        columns.append(
            F.struct(*[F.lit(v).alias(k) for k, v in parameters.items()]).alias(
                "analysis_parameters"
            )
        )
    return per_video.agg(F.countDistinct(key).alias("_videos")).select(*columns)


def report_document(
    per_video: DataFrame,
    header: DataFrame,
    name: str,
    max_videos: int = 10_000,
    key: str = "video_key",
) -> DataFrame:
    """The whole report as one indented JSON document in one row.

    This puts one entry per video into one row, so it is refused above ``max_videos``;
    ``write_report`` has no such bound.
    """
    if per_video.select(key).limit(max_videos + 1).count() > max_videos:
        raise ValueError(f"more than {max_videos} videos: use write_report")
    fields = F.struct(*[c for c in per_video.columns if c != key])
    videos = per_video.agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct(F.col(key).alias("k"), fields.alias("v"))),
                lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0),
            )
        ).alias(name)
    )
    parts = [header.select(c).scalar().alias(c) for c in header.columns]
    document = F.to_json(F.struct(name, *parts), {**JSON_OPTIONS, "pretty": "true"})
    return videos.select(document.alias("document"))


def write_report(per_video: DataFrame, header: DataFrame, path: str, key: str = "video_key") -> None:
    """Write the per-video table as Parquet and as one JSON line per video, and the header."""
    per_video.write.mode("overwrite").parquet(f"{path}/table")
    stored = per_video.sparkSession.read.parquet(f"{path}/table")
    stored.write.mode("overwrite").options(**JSON_OPTIONS).json(f"{path}/videos")
    header.write.mode("overwrite").options(**JSON_OPTIONS).json(f"{path}/header")
