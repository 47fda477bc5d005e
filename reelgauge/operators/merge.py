"""Incremental merge of new comments into the previous snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.operators.joins import join_lookup, kept
from reelgauge.operators.ranking import newest_per_key, with_row_index

KEY, SEQ = "video_key", "arrival_seq"


def high_water_marks(previous: DataFrame, key: str = KEY) -> DataFrame:
    """Greatest publish time per video; comments without one count as ``''``."""
    time = F.coalesce(F.col("published_at"), F.lit(""))
    return previous.groupBy(key).agg(F.max(time).alias("mark"))


def video_ends(previous: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Mark and last arrival number per video."""
    time = F.coalesce(F.col("published_at"), F.lit(""))
    return previous.groupBy(key).agg(F.max(time).alias("mark"), F.max(seq).alias("last_seq"))


def _time() -> Column:
    return F.coalesce(F.col("published_at"), F.lit(""))


def comment_id() -> Column:
    """Digest of what stays the same when a comment is fetched again; its likes may change."""
    return F.md5(F.to_json(F.struct("author", "text"), {"ignoreNullFields": "false"}))


def at_mark(previous: DataFrame, marks: DataFrame, key: str = KEY) -> DataFrame:
    """How often each comment is stored at the very time of its video's mark: the multiset
    (video, digest, copies) that equal times are held against."""
    last = join_lookup(previous.select(key, _time().alias("_at"), "author", "text"), marks.select(key, "mark"), key)
    return last.where(F.col("_at") == F.col("mark")).groupBy(key, comment_id().alias("_digest")).agg(F.count("*").alias("copies"))


def unseen_at_mark(
    new: DataFrame, marks: DataFrame, stored: DataFrame, key: str = KEY, seq: str = SEQ
) -> DataFrame:
    """Comments with the very time of the mark beyond the copies that are stored: the n-th equal
    one is new where fewer than n are stored. Only equal comments of one video meet in a task."""
    marked = join_lookup(new, marks.select(key, "mark"), key)
    equal = marked.where(_time() == F.col("mark")).withColumn("_digest", comment_id())
    nth = F.row_number().over(Window.partitionBy(key, "_digest").orderBy(seq))
    counted = join_lookup(equal.withColumn("_nth", nth), stored, [key, "_digest"], "left")
    return counted.where(F.col("_nth") > F.coalesce("copies", F.lit(0))).select(*new.columns)


def newer_or_unseen(
    new: DataFrame, marks: DataFrame, stored: DataFrame, key: str = KEY, seq: str = SEQ
) -> DataFrame:
    """Comments after their video's mark, and those at its time that are not stored yet. Fetching
    the same comments again adds nothing, and none that shares the mark's time is lost."""
    marked = join_lookup(new, marks.select(key, "mark"), key, "left")
    after = marked.where(F.col("mark").isNull() | (_time() > F.col("mark"))).drop("mark")
    return after.select(*new.columns).unionByName(unseen_at_mark(new, marks, stored, key, seq))


def newer_than_mark(new: DataFrame, marks: DataFrame, key: str = KEY) -> DataFrame:
    """Comments strictly newer than their video's mark; all where there is none."""
    marked = join_lookup(new, marks, key, "left")
    fresh = F.col("mark").isNull() | (F.col("mark") == "") | (F.col("published_at") > F.col("mark"))
    return marked.where(fresh).drop("mark")


def arrive_after(
    fresh: DataFrame, ends: DataFrame, key: str = KEY, seq: str = SEQ
) -> DataFrame:
    """Number the new comments on from the last stored one of their video, in their own order,
    so that arrival numbers stay unique inside a video."""
    numbered = join_lookup(with_row_index(fresh, key, seq, "_index"), ends, key, "left")
    number = F.coalesce(F.col("last_seq") + 1, F.lit(0)) + F.col("_index")
    return numbered.withColumn(seq, number).drop("last_seq", "_index")


def of_listed_videos(comments: DataFrame, videos: DataFrame, key: str = KEY) -> DataFrame:
    listed = kept(videos.select(key).distinct())
    return join_lookup(comments, listed, key, "left_semi")


def of_unlisted_videos(comments: DataFrame, videos: DataFrame, key: str = KEY) -> DataFrame:
    """What a new snapshot leaves out."""
    listed = kept(videos.select(key).distinct())
    return join_lookup(comments, listed, key, "left_anti")


def merge_comments(
    previous: DataFrame,
    new: DataFrame,
    videos: DataFrame | None = None,
    failed: DataFrame | None = None,
    cap: int | None = None,
    on_missing: str = "carry",
    key: str = KEY,
    equal_times: str = "skip",
) -> DataFrame:
    """Previous comments, then the comments newer than each video's mark.

    Comments with the time of the mark are skipped; ``equal_times="compare"`` takes those that the
    snapshot does not hold yet.

    New comments get arrival numbers after the stored ones. With ``cap`` only the newest so many of
    each video are taken; the mark moves past the others, which no later run brings back. Nothing is de-duplicated. ``videos``
    limits the snapshot to listed videos. Videos in ``failed`` could not be fetched: their history
    is carried, or dropped on request.
    """
    if on_missing not in ("carry", "drop"):
        raise ValueError("on_missing is 'carry' or 'drop'")
    if equal_times not in ("skip", "compare"):
        raise ValueError("equal_times is 'skip' or 'compare'")
    if videos is not None:
        previous = of_listed_videos(previous, videos, key)
        new = of_listed_videos(new, videos, key)
    if failed is not None and on_missing == "drop":
        previous = of_unlisted_videos(previous, failed, key)
    ends = kept(video_ends(previous, key))
    if equal_times == "compare":
        fresh = newer_or_unseen(new, ends, kept(at_mark(previous, ends, key)), key)
    else:
        fresh = newer_than_mark(new, ends.select(key, "mark"), key)
    if cap is not None:
        fresh = newest_per_key(fresh, cap, key)
    fresh = arrive_after(fresh, ends.select(key, "last_seq"), key)
    return previous.withColumn("is_new", F.lit(False)).unionByName(
        fresh.withColumn("is_new", F.lit(True))
    )


def merge_counts(merged: DataFrame, key: str = KEY) -> DataFrame:
    return merged.groupBy(key).agg(
        F.count("*").alias("total_comments"), F.count_if("is_new").alias("new_comments")
    )
