"""Video metadata: search, allow-list, one video per movie, most viewed first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.functions import text as T
from reelgauge.functions.fixed import (
    CUT_WORD,
    PERIOD_DAYS,
    SEARCH_PHRASES,
    STUDIOS,
    TOP_VIDEOS,
)
from reelgauge.functions.values import days_before, iso_width, text_or_empty


def allowed_publishers(
    videos: DataFrame, allowed: Sequence[str] = STUDIOS, column: str = "channel_title"
) -> DataFrame:
    """Keep videos whose trimmed publisher is listed; a missing publisher is not."""
    return videos.where(T.strip(text_or_empty(F.col(column))).isin(list(allowed)))


def published_within(
    videos: DataFrame, as_of: Column, days: int = PERIOD_DAYS, column: str = "published_at"
) -> DataFrame:
    """Published after ``as_of`` less ``days``; both are ISO text, brought to one width, as times
    with and without fractions of a second do not compare as text."""
    return videos.where(iso_width(column) > iso_width(days_before(as_of, days)))


def matching_phrases(
    videos: DataFrame, phrases: Sequence[str] = SEARCH_PHRASES, column: str = "title"
) -> DataFrame:
    """One row per video and phrase its title contains, duplicates kept."""
    title = F.lower(F.col(column))
    hits = [F.when(title.contains(p.lower()), F.lit(p)) for p in phrases]
    found = F.array_compact(F.array(*hits))
    return videos.withColumn("phrase", F.explode(found))


def most_viewed_per_phrase(matches: DataFrame, n: int, seq: str = "arrival_seq") -> DataFrame:
    """The ``n`` most viewed results of each phrase; tasks pre-limit before the shuffle."""
    order = Window.partitionBy("phrase").orderBy(F.desc("view_count"), F.asc(seq))
    return matches.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def with_movie_key(videos: DataFrame, cut_word: str = CUT_WORD, column: str = "title") -> DataFrame:
    return videos.withColumn("movie_key", T.movie_key(column, cut_word))


def valid_videos(videos: DataFrame) -> DataFrame:
    """Both id and title present."""
    return videos.where(T.has_text("video_id") & T.has_text("title"))


def one_per_movie(videos: DataFrame, key: str = "movie_key", seq: str = "arrival_seq") -> DataFrame:
    """The most viewed video of each movie key, the first arrival among equals.

    ``first_seen`` is the first arrival of the movie key, which orders equal views later. One
    aggregate: each task sends one row per key, however many videos share it.
    """
    row = F.struct(*[F.col(c) for c in videos.columns if c != key])
    best = F.max_by(row, F.struct(F.col("view_count"), -F.col(seq)))
    return (
        videos.groupBy(key)
        .agg(best.alias("_best"), F.min(seq).alias("first_seen"))
        .select(key, "_best.*", "first_seen")
    )


def most_viewed(videos: DataFrame, n: int = TOP_VIDEOS) -> DataFrame:
    return videos.orderBy(F.desc("view_count"), F.asc("first_seen")).limit(n)


def select_videos(
    videos: DataFrame,
    allowed: Sequence[str] = STUDIOS,
    n: int = TOP_VIDEOS,
    cut_word: str = CUT_WORD,
) -> DataFrame:
    """Allowed publishers, one video per movie, the ``n`` most viewed."""
    listed = with_movie_key(allowed_publishers(videos, allowed), cut_word)
    return most_viewed(one_per_movie(listed), n)
