"""Row numbers and newest-N per video that hold when one video has most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.operators.joins import join_lookup, kept, total_width

# Sequence numbers are unique inside a video, so a block of 2**18 consecutive numbers holds at
# most that many rows. This bounds what one task ranks.
BLOCK_BITS = 18


def with_row_index(
    df: DataFrame,
    key: str = "video_key",
    seq: str = "arrival_seq",
    name: str = "row_index",
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Row index 0..n-1 inside each video, in ``seq`` order (unique inside a video).

    Rows are numbered inside blocks of the sequence and shifted by the row count of the earlier
    blocks, so a video of any size is spread over many tasks. Key and sequence are not NULL.
    """
    blocks = df.withColumn("_block", F.shiftright(seq, block_bits))
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        blocks.groupBy(key, "_block")
        .agg(F.count("*").alias("_n"))
        .select(key, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy(key, "_block").orderBy(seq)
    return (
        blocks.withColumn("_rank", F.row_number().over(inside))
        .join(shifts, [key, "_block"])
        .withColumn(name, F.col("_shift") + F.col("_rank") - 1)
        .select(*df.columns, name)
    )


def index_page(df: DataFrame, start: int, size: int, name: str = "row_index") -> DataFrame:
    """Rows whose index lies in ``[start, start + size)``."""
    return df.where((F.col(name) >= start) & (F.col(name) < start + size))


def block_index(
    df: DataFrame, key: str = "video_key", seq: str = "arrival_seq", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """A small index for ``indexed_page``: of each video's blocks of sequence numbers the rows and
    the index of the first. One row for each block; store it beside the comments."""
    counted = df.groupBy(key, F.shiftright(seq, block_bits).alias("block")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("first_index", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def indexed_page(
    df: DataFrame,
    index: DataFrame,
    video: str,
    start: int,
    size: int,
    key: str = "video_key",
    seq: str = "arrival_seq",
    name: str = "row_index",
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """The rows of one video whose index lies in ``[start, start + size)``, found by its block index.

    Only the blocks of the page are read and numbered: the range of their sequence numbers reaches
    the scan, where it prunes files and row groups of comments that are sorted by video and number.
    """
    inside = (F.col(key) == video) & (F.col("first_index") < start + size) & (F.col("first_index") + F.col("n") > start)
    met = index.where(inside).agg(F.min("block"), F.max("block"), F.min("first_index")).first()
    if met[0] is None:
        return df.withColumn(name, F.lit(0).cast("bigint")).limit(0)
    low, high, first = met
    rows = df.where((F.col(key) == video) & (F.col(seq) >= low << block_bits) & (F.col(seq) < (high + 1) << block_bits))
    shift = index.where((F.col(key) == video) & F.col("block").between(low, high)).select("block", "first_index")
    blocks = rows.withColumn("_block", F.shiftright(seq, block_bits))
    inside_block = Window.partitionBy("_block").orderBy(seq)
    ranked = blocks.withColumn("_rank", F.row_number().over(inside_block))
    placed = join_lookup(ranked, shift.withColumnRenamed("block", "_block"), "_block")
    numbered = placed.withColumn(name, F.col("first_index") + F.col("_rank") - 1).select(*df.columns, name)
    return index_page(numbered, start, size, name)


def newest_first(df: DataFrame, time: str = "published_at", seq: str = "arrival_seq") -> DataFrame:
    """Comments by publish time, newest first; equal times go by arrival."""
    return df.orderBy(F.desc_nulls_last(time), F.asc(seq))


def newest_per_key(
    df: DataFrame,
    cap: int,
    key: str = "video_key",
    time: str = "published_at",
    seq: str = "arrival_seq",
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """The newest ``cap`` rows of each video; equal times go by arrival.

    Finds the time and sequence number of each video's ``cap``-th row from counts over narrow
    columns, hour by hour and then finer, and filters the full rows once against that small
    table. The full rows are not shuffled or sorted.
    """
    moment = F.coalesce(F.col(time), F.lit(""))
    narrow = df.select(F.col(key).alias("_k"), moment.alias("_t"), F.col(seq).alias("_s"))
    grains = [
        F.substring("_t", 1, 13),
        F.substring("_t", 1, 19),
        F.col("_t"),
        -F.shiftright("_s", block_bits),
    ]
    newest_first = Window.partitionBy("_k").orderBy(F.desc("_g"))
    rows = narrow.withColumn("_need", F.lit(cap).cast("bigint"))
    for grain in grains:
        counted = (
            rows.groupBy("_k", grain.alias("_g"))
            .agg(F.count("*").alias("_n"), F.max("_need").alias("_need"))
            .withColumn("_upto", F.sum("_n").over(newest_first))
        )
        edge = kept(
            counted.where(
                (F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need"))
            ).select("_k", "_g", "_n", (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_need"))
        )
        largest, size = edge.agg(F.max("_n"), total_width(edge)).first()
        if largest is None:
            return df
        rows = join_lookup(
            rows.drop("_need").withColumn("_g", grain), edge.drop("_n"), ["_k", "_g"], size=size
        ).drop("_g")
        if largest <= 1 << block_bits:
            break
        rows = kept(rows)
    last = Window.partitionBy("_k").orderBy(F.desc("_t"), "_s")
    cut = kept(
        rows.withColumn("_r", F.row_number().over(last))
        .where(F.col("_r") == F.col("_need"))
        .select(F.col("_k").alias(key), F.col("_t").alias("_cut_t"), F.col("_s").alias("_cut_s"))
    )
    within = (
        F.col("_cut_t").isNull()
        | (moment > F.col("_cut_t"))
        | ((moment == F.col("_cut_t")) & (F.col(seq) <= F.col("_cut_s")))
    )
    return join_lookup(df, cut, key, "left").where(within).select(*df.columns)
