"""Incremental ingestion of landed comment files as a restartable stream."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reelgauge.operators.joins import kept, release_after
from reelgauge.operators.merge import arrive_after, at_mark, newer_or_unseen, newer_than_mark, video_ends
from reelgauge.operators.ranking import newest_per_key
from reelgauge.schemas import COMMENT, COMMENT_ROW, CORRUPT, with_corrupt
from reelgauge.sources.comments import (
    KEY_IN_JSON,
    good_comments,
    key_from_path,
    number_by_place,
    place,
    source_file,
)

# All that a stream has taken in is one snapshot, which sorts after every run id.
CURRENT = "current"

MARKS = StructType(
    [
        StructField("video_key", StringType()),
        StructField("mark", StringType()),
        StructField("last_seq", LongType()),
        StructField("run", StringType()),
        StructField("batch_id", LongType()),
    ]
)
AT_MARK = StructType(
    [
        StructField("video_key", StringType()),
        StructField("_digest", StringType()),
        StructField("copies", LongType()),
        StructField("mark", StringType()),
        StructField("run", StringType()),
        StructField("batch_id", LongType()),
    ]
)
STORED = StructType([*COMMENT_ROW.fields, StructField("batch_id", LongType())])


def landing_stream(
    spark: SparkSession,
    landing: str,
    multiline: bool = True,
    pattern: str = KEY_IN_JSON,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = (
        spark.readStream.schema(with_corrupt(COMMENT))
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(landing).select(
        *COMMENT.names,
        CORRUPT,
        key_from_path(source_file(), pattern).alias("video_key"),
        *place(),
    )


def _read_batches(
    spark: SparkSession, folder: str, schema: StructType, before_batch: int | None
) -> DataFrame:
    try:
        rows = spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:  # the folder does not exist before the first batch
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    return rows if before_batch is None else rows.where(F.col("batch_id") < before_batch)


def stored_comments(spark: SparkSession, target: str) -> DataFrame:
    """Comments ingested so far; an empty frame before the first batch."""
    return _read_batches(spark, target, STORED, None)


def _write_batch(rows: DataFrame, folder: str) -> None:
    (
        rows.write.partitionBy("batch_id")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(folder)
    )


def ingest_stream(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    snapshot: str = CURRENT,
    cap: int | None = None,
    multiline: bool = True,
    pattern: str = KEY_IN_JSON,
    files_per_batch: int | None = None,
    run: str | None = None,
    equal_times: str = "skip",
) -> StreamingQuery:
    """Append comments newer than each video's mark; every file is read once.

    ``target`` becomes a comments table that ``read_comments`` reads: what all runs have taken in
    is one snapshot, named ``snapshot``. The marks lie beside it, in ``target`` with ``_marks`` and
    ``_at_mark`` at its end.

    Each micro-batch writes its own ``batch_id`` partition of the comments and of the marks, and
    reads the earlier marks only: the stored comments are not scanned again, and a batch that is
    run again after a failure replaces itself. New comments go by file and place in the file;
    arrival numbers go on where the video's stored comments end.

    A comment is held against the marks of earlier runs only, not against those of earlier batches of
    its own run, so that ``files_per_batch`` does not change which comments are kept; ``cap`` counts
    per batch. ``equal_times="compare"`` takes comments at the time of the mark that no earlier run
    has stored. Each call is a run of its own unless ``run`` names one: a call that goes on with a
    failed run takes that run's name.
    """
    run = run or uuid.uuid4().hex

    def merge(batch: DataFrame, batch_id: int) -> None:
        with release_after():
            merge_batch(batch, batch_id)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        new = number_by_place(good_comments(batch)).withColumn("snapshot", F.lit(snapshot))
        marks = _read_batches(spark, f"{target}_marks", MARKS, batch_id)
        of_others = ~F.col("run").eqNullSafe(run)
        ends = kept(
            marks.groupBy("video_key").agg(
                F.max(F.when(of_others, F.col("mark"))).alias("mark"),
                F.max("last_seq").alias("last_seq"),
            )
        )
        if equal_times == "compare":
            stored = _read_batches(spark, f"{target}_at_mark", AT_MARK, batch_id).where(of_others)
            known = stored.groupBy("video_key", "mark", "_digest").agg(F.sum("copies").alias("copies"))
            at = kept(known.join(ends.select("video_key", "mark"), ["video_key", "mark"]).drop("mark"))
            fresh = newer_or_unseen(new, ends.where("mark is not null"), at)
        else:
            fresh = newer_than_mark(new, ends.drop("last_seq"))
        if cap is not None:
            fresh = newest_per_key(fresh, cap)
        rows = arrive_after(fresh, ends.drop("mark"))
        number = F.lit(batch_id).cast("bigint")
        _write_batch(rows.withColumn("batch_id", number).select(*STORED.names), target)
        written = stored_comments(spark, target).where(F.col("batch_id") == batch_id)
        reached = kept(video_ends(written))
        labels = {"run": F.lit(run), "batch_id": number}
        counts = at_mark(written, reached).join(reached.select("video_key", "mark"), "video_key")
        _write_batch(counts.withColumns(labels).select(*AT_MARK.names), f"{target}_at_mark")
        _write_batch(reached.withColumns(labels).select(*MARKS.names), f"{target}_marks")

    stream = landing_stream(spark, landing, multiline, pattern, files_per_batch)
    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
