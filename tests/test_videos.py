import pytest
from pyspark.sql import functions as F

from reelgauge.operators import leaderboard as B
from reelgauge.operators import videos as V

SCHEMA = "video_id string, title string, view_count bigint, channel_title string, arrival_seq bigint"


@pytest.fixture
def videos(spark):
    data = [
        ("k1", "kong trailer", 3, "Netflix", 0),
        ("s1", "sea trailer", 7, "Netflix", 1),
        ("s2", "sea trailer two", 7, " Netflix ", 2),
        ("x1", "other trailer", 99, "Somebody", 3),
        ("x2", "lost trailer", 99, None, 4),
        ("k2", "kong trailer final", 7, "Disney", 9),
        ("d1", "deep", 5, "Pixar", 10),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_publishers_are_trimmed_and_required(videos, rows):
    kept = V.allowed_publishers(videos)
    assert [r[0] for r in rows(kept, "video_id")] == ["d1", "k1", "k2", "s1", "s2"]


def test_one_per_movie_keeps_the_first_of_equals(videos, rows):
    best = V.one_per_movie(V.with_movie_key(V.allowed_publishers(videos)))
    assert rows(best, "movie_key", "video_id", "first_seen") == [
        ("deep", "d1", 10), ("kong", "k2", 0), ("sea", "s1", 1),
    ]


def test_equal_views_follow_the_first_arrival_of_the_movie(videos):
    assert [r["video_id"] for r in V.select_videos(videos, n=2).collect()] == ["k2", "s1"]
    assert [r["video_id"] for r in V.select_videos(videos).collect()] == ["k2", "s1", "d1"]


def test_empty_movie_keys_collapse(spark, rows):
    frame = spark.createDataFrame(
        [("a", "Trailer A", 1, "DC", 0), ("b", "Trailer B", 2, "DC", 1)], SCHEMA
    )
    assert rows(V.one_per_movie(V.with_movie_key(frame)), "movie_key", "video_id") == [("", "b")]


def test_recent(spark, rows):
    frame = spark.createDataFrame(
        [("old", "2024-10-27T15:08:35.000000Z"), ("new", "2024-10-27T15:08:35.000001Z")],
        "video_id string, published_at string",
    )
    as_of = F.lit("2025-01-25 15:08:35").cast("timestamp_ntz")
    assert rows(V.published_within(frame, as_of, 90), "video_id") == [("new",)]


def test_phrases_give_one_row_each(spark, rows):
    frame = spark.createDataFrame(
        [("a", "Official Trailer: new trailer", 5, "DC", 0), ("b", "nothing", 1, "DC", 1),
         ("c", "NEW TRAILER", 9, "DC", 2)], SCHEMA,
    )
    found = V.matching_phrases(frame)
    assert rows(found, "video_id", "phrase") == [
        ("a", "new trailer"), ("a", "official trailer"), ("c", "new trailer"),
    ]
    top = V.most_viewed_per_phrase(found, 1)
    assert rows(top, "phrase", "video_id") == [("new trailer", "c"), ("official trailer", "a")]


def test_valid_videos(spark, rows):
    frame = spark.createDataFrame(
        [("a", "t"), ("", "t"), (None, "t"), ("b", ""), ("c", None)], "video_id string, title string"
    )
    assert rows(V.valid_videos(frame)) == [("a", "t")]


def test_leaderboard_by_likes_with_search(spark):
    videos = spark.createDataFrame(
        [("a", "Kong Rises", 14940612, 276665), ("b", "Sea kong", 51289843, 1180196),
         ("c", "Deep", 1, 2)],
        "video_key string, title string, view_count bigint, like_count bigint",
    )
    labels = spark.createDataFrame([("b", "positive", 3)], "video_key string, sentiment string, count bigint")
    board = B.leaderboard(videos, labels, "KONG").collect()
    assert [(r["video_key"], r["views"], r["likes"], r["sentiment"]) for r in board] == [
        ("b", "51,289,843", "1,180,196", "positive"), ("a", "14,940,612", "276,665", None),
    ]
    assert B.leaderboard(videos, labels, "").count() == 3
