"""Sharding by sampled splitters, with shards of near equal bytes.

Records are ordered by (hash of the text, doc_id), so that equal texts lie together. A size-weighted
sample of these keys gives quantile boundaries, which cut the records into many more ranges than
shards; ranges that turn out overfull are cut again by a sample of their own. All records of a range
are then summed in order, and a shard takes the records whose bytes begin in its sixteenth of the
total. A group of equal texts that is larger than a shard goes on in the next one: doc_id is part of
the key, so that it is cut like any other range.

Only narrow rows are sorted; texts move only where ``carry`` asks for them. The driver sees the sample
and one row for each range, numbers that do not grow with the table.

Defined cases: a null text has size 1 and the checksum of no bytes; a null doc_id comes first;
repeated rows take a slot each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from reelgauge.operators.joins import join_lookup

from .common import saved

#: Ranges for each shard, and sampled keys for each range.
RANGES, SAMPLES = 64, 16
#: A range with more than so many times its share is cut again, at most ROUNDS times.
OVERFULL, ROUNDS = 2.0, 3

_LEAST = -(1 << 63)


def _weight(total: int, rows: int) -> Column:
    """Half by bytes and half by rows, so that many small records make ranges too."""
    return F.col("size") / F.lit(float(total)) + F.lit(1.0 / rows)


def _sample(records: DataFrame, weight: Column, count: int, seed: int) -> pd.DataFrame:
    """Keys drawn without replacement by weight: those whose exponential waiting times are least,
    found among those below a time that about half more of them reach, so that tasks send few."""
    uniform = (F.shiftrightunsigned(F.xxhash64("key", "id", F.lit(seed)), 11).cast("double") + 1) / F.lit(float((1 << 53) + 1))
    waiting = records.select("key", "id", (-F.log(uniform) / weight).alias("wait"), weight.alias("weight"))
    rows, mass = waiting.agg(F.count("*"), F.sum("weight")).first()
    until = 1.5 * count / mass if rows else 0.0
    while rows and waiting.where(F.col("wait") <= until).count() < min(count, rows):
        until *= 2
    return waiting.where(F.col("wait") <= until).orderBy("wait", "key", "id").limit(count).select("key", "id").toPandas()


def _boundaries(sample: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """Quantiles of the sampled keys."""
    ordered = sample.sort_values(["key", "id"]).reset_index(drop=True)
    if not len(ordered):
        return ordered
    at = np.unique(np.arange(1, ranges) * len(ordered) // ranges)
    return ordered.iloc[at].drop_duplicates()


def _range_of(bounds: pd.DataFrame):
    """The number of boundaries that lie at or before a key, as a column function."""
    bounds = bounds.sort_values(["key", "id"])
    keys, ids = bounds["key"].to_numpy(np.int64), bounds["id"].to_numpy(np.int64)

    @F.pandas_udf(IntegerType())
    def find(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for key, id_ in parts:
            key, id_ = key.to_numpy(np.int64), id_.to_numpy(np.int64)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            found = low.copy()
            for a in np.unique(low[low < high]):  # keys that are boundaries
                here = np.flatnonzero((low == a) & (high > a))
                found[here] = a + np.searchsorted(ids[a:high[here[0]]], id_[here], "right")
            yield pd.Series(found.astype(np.int32))

    return find


def sharded(docs: DataFrame, shards: int = 16, carry: tuple[str, ...] = (), seed: int = 11) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, shard, slot (from 0 without gaps
    in each shard), and the columns named in ``carry``."""
    text = F.col("text").cast("string")
    records = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("id"),
            *[F.col(f"`{c}`").alias(f"carried_{c}") for c in carry],
        ),
        "shard-records",
    )
    total, rows = (x or 0 for x in records.agg(F.sum("size"), F.count("*")).first())
    weight, ranges = _weight(max(total, 1), max(rows, 1)), shards * RANGES
    bounds = _boundaries(_sample(records, weight, ranges * SAMPLES, seed), ranges)
    for again in range(1, ROUNDS + 1):
        placed = records.withColumn("range", _range_of(bounds)("key", "id"))
        full = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.sum(weight).alias("weight"), F.max(F.struct("key", "id")) != F.min(F.struct("key", "id"))).toPandas()
        full.columns = ["range", "bytes", "rows", "weight", "mixed"]
        over = full[(full["weight"] > OVERFULL * 2 / ranges) & full["mixed"]]
        if again > ROUNDS - 1 or not len(over):
            break
        extra = int(np.ceil(over["weight"].sum() * ranges)) + len(over)
        inside = placed.where(F.col("range").isin(over["range"].tolist()))
        bounds = pd.concat([bounds, _boundaries(_sample(inside, weight, extra * SAMPLES, seed + again), extra)]).drop_duplicates()
    full = full.sort_values("range")
    starts = [(int(r), int(b), int(n)) for r, b, n in zip(full["range"], full["bytes"].cumsum() - full["bytes"], full["rows"].cumsum() - full["rows"], strict=True)]
    lookup = docs.sparkSession.createDataFrame(starts, "range int, bytes_before long, rows_before long")
    order = Window.partitionBy("range").orderBy("key", "id", "size", "text_crc32")
    summed = placed.withColumn("nth", F.row_number().over(order)).withColumn("through", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    middle = 2 * (F.col("bytes_before") + F.col("through")) - F.col("size")
    numbered = saved(
        join_lookup(summed, lookup, "range").select(
            "doc_id", "size", "text_crc32",
            F.least(F.floor(middle / F.lit(2.0 * max(total, 1)) * shards), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("place"),
            *[f"carried_{c}" for c in carry],
        ),
        "shard-places",
    )
    first = numbered.groupBy("shard").agg(F.min("place").alias("first"))  # a row for each shard
    return numbered.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"), *[F.col(f"carried_{c}").alias(c) for c in carry])


def write_shards(docs: DataFrame, folder: str, shards: int = 16) -> None:
    """The documents in a folder for each shard, in the order of their slots."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    rows = sharded(docs, shards, others)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
