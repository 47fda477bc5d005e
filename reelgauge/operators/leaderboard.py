"""Videos with their dominant sentiment, most liked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.functions import text as T
from reelgauge.functions.values import with_thousands
from reelgauge.operators.joins import join_lookup, kept

KEY = "video_key"


def search_titles(videos: DataFrame, query: str | None, column: str = "title") -> DataFrame:
    return videos if not query else videos.where(T.contains_text(column, query))


def leaderboard(
    videos: DataFrame, dominant: DataFrame, query: str | None = None, key: str = KEY
) -> DataFrame:
    """Title, views, likes and dominant label; videos without comments have no label."""
    rows = join_lookup(search_titles(videos, query), kept(dominant.select(key, "sentiment")), key, "left")
    return rows.select(
        key,
        "title",
        with_thousands(F.col("view_count")).alias("views"),
        with_thousands(F.col("like_count")).alias("likes"),
        "sentiment",
        "view_count",
        "like_count",
    ).orderBy(F.desc("like_count"), F.asc(key))
