"""Explicit schemas; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_text, _int, _long = StringType(), IntegerType(), LongType()

COMMENT = _struct(author=_text, text=_text, like_count=_int, published_at=_text)

COMMENT_ROW = StructType(
    [*COMMENT.fields, *_struct(video_key=_text, snapshot=_text, arrival_seq=_long).fields]
)

VIDEO = _struct(
    video_id=_text, title=_text, published_at=_text, view_count=_long, like_count=_long,
    comment_count=_long, video_url=_text, channel_title=_text,
)

# Landed responses, one row per response page. ``page_seq`` is the fetch order.
SEARCH_PAGE = _struct(
    page_seq=_long,
    items=ArrayType(_struct(id=_struct(videoId=_text))),
    nextPageToken=_text,
)

VIDEO_PAGE = _struct(
    page_seq=_long,
    items=ArrayType(
        _struct(
            id=_text,
            snippet=_struct(channelTitle=_text, title=_text, publishedAt=_text),
            statistics=_struct(viewCount=_text, likeCount=_text, commentCount=_text),
        )
    ),
)

_THREAD = _struct(
    authorDisplayName=_text, textDisplay=_text, likeCount=_int, publishedAt=_text
)

THREAD_PAGE = _struct(
    page_seq=_long,
    video_id=_text,
    status=_text,
    items=ArrayType(
        _struct(snippet=_struct(topLevelComment=_struct(snippet=_THREAD), videoId=_text))
    ),
    nextPageToken=_text,
)

CORRUPT = "_corrupt_record"


def with_corrupt(schema: StructType) -> StructType:
    """The schema plus the column that takes unreadable text."""
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])
