"""Comment snapshots: JSON in, partitioned Parquet out, and the scans of both layouts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelgauge.operators.joins import join_lookup, kept
from reelgauge.operators.snapshots import latest_snapshot, pinned_snapshot
from reelgauge.schemas import COMMENT, COMMENT_ROW, CORRUPT
from reelgauge.sources.landing import read_json, unreadable

KEY_IN_JSON = r"([^/]+)_comments\.json"
# The video id, at most eleven characters at the end of the file's stem, whatever the title.
ID_IN_JSON = r"([^/]{1,11})_comments\.json"
ID_IN_PARQUET = r"([^/]{1,11})_comments\.parquet"
KEY_IN_PARQUET = r"([^/]+)_comments\.parquet"


def source_file() -> Column:
    """Decoded path of the file a row was read from."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def key_from_path(path: Column, pattern: str) -> Column:
    """Video key inside a path, ``''`` where the pattern is absent."""
    return F.regexp_extract(path, pattern, 1)


def place() -> list[Column]:
    """Columns that tell where a row was read: the file, the part of it, the row in the part."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_part")]


def number_by_place(rows: DataFrame, key: str = "video_key") -> DataFrame:
    """``arrival_seq`` from (file, place in the file) inside each video, in place of the columns of
    ``place``. The parts of files are ranked by video; no row is sorted or shuffled."""
    numbered = rows.withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    by_name = Window.partitionBy(key).orderBy("_file", "_part")
    parts = rows.select(key, "_file", "_part").distinct()
    ranks = kept(parts.select(key, "_file", "_part", (F.row_number().over(by_name) - 1).cast("bigint").alias("_rank")))
    placed = join_lookup(numbered, ranks, [key, "_file", "_part"])
    return placed.withColumn("arrival_seq", F.shiftleft("_rank", 33) + F.col("_row")).drop("_file", "_part", "_rank", "_row")


def read_landed_comments(
    spark: SparkSession, src: str, multiline: bool = True, pattern: str = KEY_IN_JSON
) -> DataFrame:
    """Comment JSON files with key, arrival order and the corrupt-record column.

    Arrival numbers go by the files of a video in the order of their names, then by the place in
    the file.
    """
    raw = read_json(spark, src, COMMENT, multiline)
    return number_by_place(
        raw.select(
            *COMMENT.names,
            CORRUPT,
            key_from_path(source_file(), pattern).alias("video_key"),
            *place(),
        )
    )


def good_comments(landed: DataFrame) -> DataFrame:
    """Readable rows with a video key."""
    data = F.lit(False)
    for name in COMMENT.names:
        data = data | F.col(name).isNotNull()
    return landed.where((F.col(CORRUPT).isNull() | data) & (F.col("video_key") != "")).drop(CORRUPT)


def rejected_files(spark: SparkSession, src: str, multiline: bool = True) -> DataFrame:
    """Files (or lines) that hold no record, with their raw text."""
    return unreadable(read_json(spark, src, COMMENT, multiline))


def write_comments(
    rows: DataFrame, dst: str, by_video: bool = False, mode: str = "overwrite"
) -> None:
    """Write ``COMMENT_ROW`` partitioned by snapshot.

    By default rows are rebalanced on the video and sorted: adaptive execution sizes the output
    tasks, splits a hot video over many files and lets small videos share one, and row-group
    statistics prune a single-video read. ``by_video`` makes one folder per video instead.
    """
    rows = rows.select(*COMMENT_ROW.names)
    if by_video:
        writer = rows.write.partitionBy("snapshot", "video_key")
    else:
        balanced = rows.hint("rebalance", F.col("video_key"))
        order = ["snapshot", "video_key", "arrival_seq"]
        writer = balanced.sortWithinPartitions(*order).write.partitionBy("snapshot")
    writer.mode(mode).option("partitionOverwriteMode", "dynamic").parquet(dst)


def json_to_parquet(
    spark: SparkSession,
    src: str,
    dst: str,
    snapshot: str,
    rejects: str | None = None,
    multiline: bool = True,
    pattern: str = KEY_IN_JSON,
    by_video: bool = False,
) -> None:
    """Convert all comment JSON files below ``src`` into one snapshot, in one job.

    Unreadable files do not stop it; with ``rejects`` their text is written there.
    """
    landed = read_landed_comments(spark, src, multiline, pattern)
    rows = good_comments(landed).withColumn("snapshot", F.lit(snapshot))
    write_comments(rows, dst, by_video)
    if rejects:
        rejected_files(spark, src, multiline).write.mode("overwrite").json(rejects)


def read_comments(
    spark: SparkSession, root: str, snapshot: str | None = None, video: str | None = None
) -> DataFrame:
    """Comments of one snapshot, the latest where none is named, and of one video if given."""
    rows = spark.read.schema(COMMENT_ROW).parquet(root).select(*COMMENT_ROW.names)
    chosen = latest_snapshot(rows) if snapshot is None else pinned_snapshot(rows, snapshot)
    if chosen.isEmpty():
        raise ValueError(f"no snapshot {snapshot or ''} below {root}")
    if video is not None:
        return of_video(chosen, video)
    return chosen.where(F.col("video_key").isNotNull() & (F.col("video_key") != ""))


def earlier_comments(spark: SparkSession, root: str, before: str) -> DataFrame:
    """The latest snapshot before the named one; no rows where there is none yet."""
    try:
        rows = spark.read.schema(COMMENT_ROW).parquet(root).select(*COMMENT_ROW.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMENT_ROW)
    return latest_snapshot(rows.where(F.col("snapshot") < before))


def drop_older(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete the snapshot folders below ``root`` but for the newest ``keep``; their names. Only
    folders named ``snapshot=...`` are touched."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(
        x.getPath().getName() for x in files.listStatus(path)
        if x.isDirectory() and x.getPath().getName().startswith("snapshot=")
    )
    gone = found[: max(len(found) - keep, 0)] if keep > 0 else []
    for name in gone:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path, name), True)
    return [name.removeprefix("snapshot=") for name in gone]


def of_video(comments: DataFrame, video: str) -> DataFrame:
    """One video; the filter reaches the Parquet scan."""
    return comments.where(F.col("video_key") == video)


def read_comment_folders(
    spark: SparkSession, path: str, pattern: str = KEY_IN_PARQUET
) -> DataFrame:
    """The layout ``<snapshot>/<video>_comments.parquet`` with one Parquet dataset per video.

    Key and snapshot come from the path. Arrival numbers count the files of a video by name, then
    the rows of a file; finding the files reads no data columns.
    """
    rows = spark.read.schema(COMMENT).option("recursiveFileLookup", True).parquet(path)
    located = rows.select(
        *COMMENT.names, source_file().alias("input_file"), F.col("_metadata.row_index").alias("_row")
    ).withColumns(
        {
            "video_key": key_from_path(F.col("input_file"), pattern),
            "snapshot": key_from_path(F.col("input_file"), r"([^/]+)/[^/]+_comments\.parquet"),
        }
    )
    by_name = Window.partitionBy("snapshot", "video_key").orderBy("input_file")
    files = (
        located.select("snapshot", "video_key", "input_file")
        .distinct()
        .select("input_file", (F.row_number().over(by_name) - 1).cast("bigint").alias("_file"))
    )
    numbered = join_lookup(located, kept(files), "input_file")
    return numbered.withColumn("arrival_seq", F.shiftleft("_file", 40) + F.col("_row")).select(
        *COMMENT_ROW.names, "input_file"
    )


def key_counts(rows: DataFrame) -> DataFrame:
    """Rows per video, and whether the key is usable."""
    return rows.groupBy("video_key").agg(F.count("*").alias("total_comments")).withColumn(
        "usable", F.col("video_key").isNotNull() & (F.col("video_key") != "")
    )
