"""From landed responses to the selected videos and the merged comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions import text as T
from reelgauge.functions.fixed import (
    PERIOD_DAYS,
    SEARCH_PHRASES,
    STUDIOS,
    TOP_VIDEOS,
)
from reelgauge.operators import merge as M
from reelgauge.operators import videos as V
from reelgauge.operators.joins import join_lookup, kept
from reelgauge.sources import landing as L


def collect_videos(
    search_pages: DataFrame,
    video_pages: DataFrame,
    as_of: Column,
    days: int = PERIOD_DAYS,
    n: int = TOP_VIDEOS,
    allowed: Sequence[str] = STUDIOS,
    phrases: Sequence[str] | None = SEARCH_PHRASES,
) -> DataFrame:
    """Searched videos of the period by allowed publishers, one per movie, most viewed first.

    ``phrases`` repeats the search condition on titles; None trusts the search response.
    """
    details = L.searched_videos(L.flatten_search(search_pages), L.flatten_videos(video_pages))
    recent = V.published_within(details, as_of, days)
    if phrases is not None:
        wanted = F.lit(False)
        for phrase in phrases:
            wanted = wanted | T.contains_text("title", phrase)
        recent = recent.where(wanted)
    return V.select_videos(recent, allowed, n)


def collect_comments(
    previous: DataFrame,
    thread_pages: DataFrame,
    videos: DataFrame,
    snapshot: str,
    cap: int | None = None,
    on_missing: str = "carry",
    equal_times: str = "skip",
) -> DataFrame:
    """The next snapshot: listed videos' history and their comments newer than the mark.

    ``previous`` and the result are keyed by ``video_key`` holding the video id, so a new title
    does not lose a video's history. With ``equal_times="compare"`` comments at the time of a mark
    that are not stored yet are taken too.
    """
    listed = kept(V.valid_videos(videos).select(F.col("video_id").alias("video_key")).distinct())
    new = L.flatten_threads(thread_pages).withColumnRenamed("video_id", "video_key")
    new = new.withColumn("snapshot", F.lit(snapshot))
    failed = L.failed_videos(thread_pages).withColumnRenamed("video_id", "video_key")
    merged = M.merge_comments(
        previous, join_lookup(new, listed, "video_key", "left_semi"), listed, failed, cap, on_missing,
        equal_times=equal_times,
    )
    return merged.withColumn("snapshot", F.lit(snapshot))
