"""Landed response files: one row per response page, flattened to videos and comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelgauge.functions import text as T
from reelgauge.functions.values import count_or_zero, text_or_empty
from reelgauge.operators.joins import join_lookup
from reelgauge.schemas import CORRUPT, THREAD_PAGE, with_corrupt

# A page holds at most 100 items, so numbers of different pages never meet.
PAGE_STRIDE = 1 << 20

# Where a page was landed; the order of pages without ``page_seq``.
PLACE = ["_file", "_line"]


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multiline: bool = True,
    glob: str = "*.json",
    partitions: bool = False,
) -> DataFrame:
    """JSON files with a fixed schema plus the corrupt-record column; other suffixes are skipped.

    ``multiline`` reads one JSON document per file. Files of one document or array per line can be
    split over tasks, which is the form to land large data in. ``partitions`` takes columns from
    ``name=value`` folders instead of looking into all folders.
    """
    return (
        spark.read.schema(with_corrupt(schema))
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", not partitions)
        .json(path)
    )


def _no_data(df: DataFrame) -> Column:
    empty = F.lit(True)
    for name in df.columns:
        if name not in (CORRUPT, *PLACE):
            empty = empty & F.col(f"`{name}`").isNull()
    return F.col(CORRUPT).isNotNull() & empty


def readable(df: DataFrame) -> DataFrame:
    """Rows that hold data; a row with single unusable fields stays, those fields NULL."""
    return df.where(~_no_data(df)).drop(CORRUPT)


def unreadable(df: DataFrame) -> DataFrame:
    """Raw text of files or lines that hold no record at all."""
    return df.where(_no_data(df)).select(F.input_file_name().alias("input_file"), CORRUPT)


def _items(pages: DataFrame, *keep: str) -> DataFrame:
    seq = F.coalesce(F.col("page_seq"), F.lit(0)) * PAGE_STRIDE
    return pages.select(*keep, "page_seq", F.posexplode("items").alias("_pos", "_item")).select(
        *keep, F.col("_item").alias("item"), (seq + F.col("_pos")).alias("arrival_seq")
    )


def flatten_search(pages: DataFrame) -> DataFrame:
    """Distinct video ids of search response pages."""
    return (
        pages.select(F.explode("items.id.videoId").alias("video_id"))
        .where(T.has_text("video_id"))
        .distinct()
    )


def flatten_videos(pages: DataFrame, strict: bool = True) -> DataFrame:
    """Video details with defaults: empty text, 0 counts, trimmed publisher, lower-case title."""
    item = _items(pages)
    snippet, stats = F.col("item.snippet"), F.col("item.statistics")
    return item.select(
        F.col("item.id").alias("video_id"),
        F.lower(text_or_empty(snippet["title"])).alias("title"),
        text_or_empty(snippet["publishedAt"]).alias("published_at"),
        count_or_zero(stats["viewCount"], strict).alias("view_count"),
        count_or_zero(stats["likeCount"], strict).alias("like_count"),
        count_or_zero(stats["commentCount"], strict).alias("comment_count"),
        T.watch_url("item.id").alias("video_url"),
        T.strip(text_or_empty(snippet["channelTitle"])).alias("channel_title"),
        "arrival_seq",
    )


def searched_videos(found: DataFrame, videos: DataFrame) -> DataFrame:
    """Details of the searched ids."""
    return videos.join(found, "video_id", "left_semi")


def _usable() -> Column:
    """Never NULL: a page as the service returns it has items and no status."""
    return F.coalesce(F.col("status") == "ok", F.col("items").isNotNull())


def usable_pages(pages: DataFrame) -> DataFrame:
    """Pages of videos whose fetch succeeded; disabled, missing and failed ones have no output."""
    return pages.where(_usable())


def failed_videos(pages: DataFrame) -> DataFrame:
    return pages.where(~_usable()).select("video_id").distinct()


def _video_id() -> Column:
    """The page's video, or that of its first comment where the page does not say."""
    first = F.try_element_at(F.col("items.snippet.videoId"), F.lit(1))
    return F.coalesce(F.col("video_id"), first)


def thread_pages(pages: DataFrame) -> DataFrame:
    """Pages with exactly the fields of the schema; fields that they lack are NULL."""
    extra = [c for c in PLACE if c in pages.columns]
    text = F.to_json(F.struct(*[c for c in pages.columns if c not in PLACE]))
    return pages.select(F.from_json(text, THREAD_PAGE).alias("p"), *extra).select("p.*", *extra)


def flatten_threads(pages: DataFrame) -> DataFrame:
    """Top-level comments of comment-thread pages, numbered in the order of their video's pages.

    Pages go by ``page_seq`` (NULL first), then by their place as ``read_pages`` gives it, then by
    content. The pages of a video are ranked as narrow rows; numbers are unique inside a video
    whatever the pages say, and rise along a page.
    """
    extra = [c for c in PLACE if c in pages.columns]
    known = pages.select(*THREAD_PAGE.names, *extra).where(_usable())
    keyed = known.withColumns({"_video": _video_id(), "_id": F.xxhash64(F.to_json("items"))})
    order = ["page_seq", *extra, "_id"]
    if not extra:  # only equal pages meet in this window
        equal = Window.partitionBy("_video", *order).orderBy("nextPageToken")
        keyed, order = keyed.withColumn("_nth", F.row_number().over(equal)), [*order, "_nth"]
    rank = F.row_number().over(Window.partitionBy("_video").orderBy(*order)) - 1
    names = [f"_by_{i}" for i in range(len(order) + 1)]
    numbers = keyed.select("_video", *order, rank.alias("_page")).toDF(*names, "_page")
    same = F.lit(True)
    for c, other in zip(["_video", *order], names, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(other))
    item = join_lookup(keyed, numbers, same, "left").select(
        F.col("_video").alias("video_id"), "_page", F.posexplode("items").alias("_pos", "item")
    )
    comment = F.col("item.snippet.topLevelComment.snippet")
    return item.select(
        "video_id",
        comment["authorDisplayName"].alias("author"),
        comment["textDisplay"].alias("text"),
        comment["likeCount"].alias("like_count"),
        comment["publishedAt"].alias("published_at"),
        (F.col("_page") * PAGE_STRIDE + F.col("_pos")).alias("arrival_seq"),
    )


def read_pages(spark: SparkSession, path: str, schema: StructType, multiline: bool = True) -> DataFrame:
    """Readable response pages of all files below a folder, with their place: file and line."""
    raw = read_json(spark, path, schema, multiline)
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return readable(raw.select("*", F.col("_metadata.file_path").alias("_file"), line.alias("_line")))
