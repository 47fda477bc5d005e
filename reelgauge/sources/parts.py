"""Comment snapshots as lists of parts: a run writes what it adds, not the whole history.

Below the root lie ``parts/<id>`` (comments), ``drops/<id>`` (videos that a run leaves out) and
``commits/snapshot=<run>``, a small table that lists a snapshot's parts in order and is written last:
a reader sees whole runs only, and a run that fails leaves files that no commit names. A drop hides
its videos in the parts before it. When the additions outgrow a share of the base, or the parts
a number, a run writes all its comments as one new base.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelgauge.operators.joins import join_lookup, kept
from reelgauge.schemas import COMMENT_ROW

#: Rows of additions against rows of the base, and parts, beyond which a run compacts.
COMPACT_SHARE, MOST_PARTS = 0.5, 20
PART_ROW = StructType([f for f in COMMENT_ROW.fields if f.name != "snapshot"])
COMMIT = "place int, part string, part_rows bigint, drops string, snapshot string"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All commits below the root; no rows where there is none yet."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def _parts(spark: SparkSession, root: str, snapshot: str | None, before: str | None = None) -> list:
    """The parts of one snapshot in order, of the latest where none is named; at most MOST_PARTS."""
    known = commits(spark, root)
    if before is not None:
        known = known.where(F.col("snapshot") < before)
    if snapshot is None:
        snapshot = known.agg(F.max("snapshot")).first()[0]
    return known.where(F.col("snapshot") == snapshot).orderBy("place").collect()


def _read(spark: SparkSession, root: str, parts: list) -> DataFrame:
    rows = None
    for i, part in enumerate(parts):
        if part["part"] is None:
            continue
        mine = spark.read.schema(PART_ROW).parquet(f"{root}/parts/{part['part']}")
        later = [f"{root}/drops/{p['drops']}" for p in parts[i + 1:] if p["drops"]]
        if later:
            hidden = kept(spark.read.schema("video_key string").parquet(*later).distinct())
            mine = join_lookup(mine, hidden, "video_key", "left_anti")
        rows = mine if rows is None else rows.unionByName(mine)
    return spark.createDataFrame([], PART_ROW) if rows is None else rows


def read_snapshot(spark: SparkSession, root: str, snapshot: str | None = None) -> DataFrame:
    """Comments of one snapshot, the latest where none is named."""
    parts = _parts(spark, root, snapshot)
    if not parts:
        raise ValueError(f"no snapshot {snapshot or ''} below {root}")
    return _read(spark, root, parts).withColumn("snapshot", F.lit(parts[0]["snapshot"])).select(*COMMENT_ROW.names)


def previous_snapshot(spark: SparkSession, root: str, before: str) -> DataFrame:
    """What the latest snapshot before a run holds; no rows before the first."""
    rows = _read(spark, root, _parts(spark, root, None, before))
    return rows.withColumn("snapshot", F.lit(None).cast("string")).select(*COMMENT_ROW.names)


def _write_part(rows: DataFrame, root: str) -> str:
    name = uuid.uuid4().hex
    sorted_rows = rows.select(*PART_ROW.names).hint("rebalance", F.col("video_key")).sortWithinPartitions("video_key", "arrival_seq")
    sorted_rows.write.parquet(f"{root}/parts/{name}")
    return name


def add_snapshot(
    spark: SparkSession,
    root: str,
    snapshot: str,
    additions: DataFrame,
    dropped: DataFrame | None = None,
    compact_share: float = COMPACT_SHARE,
    most_parts: int = MOST_PARTS,
) -> None:
    """Commit a snapshot: the parts of the latest one before it, without the videos in ``dropped``
    (``video_key``), and ``additions``. Writing a run again replaces its commit."""
    parts = [tuple(p)[1:4] for p in _parts(spark, root, None, snapshot)]
    drops = None
    if dropped is not None and parts:
        drops = uuid.uuid4().hex
        dropped.select("video_key").distinct().write.parquet(f"{root}/drops/{drops}")
    part = _write_part(additions, root)
    rows = spark.read.schema(PART_ROW).parquet(f"{root}/parts/{part}").count()
    parts.append((part, rows, drops))
    base, added = parts[0][1], sum(p[1] for p in parts[1:])
    if len(parts) > 1 and (added > compact_share * base or len(parts) > most_parts):
        named = [{"part": p, "drops": d} for p, _, d in parts]
        part = _write_part(_read(spark, root, named), root)
        parts = [(part, spark.read.schema(PART_ROW).parquet(f"{root}/parts/{part}").count(), None)]
    listed = spark.createDataFrame([(i, *p) for i, p in enumerate(parts)], "place int, part string, part_rows bigint, drops string")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/snapshot={snapshot}")
