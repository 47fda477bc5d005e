"""Harmonic packing of token sequences.

Class j holds the lengths that fit j times into a sequence, so a bin of class j takes j pieces,
whatever other workers do. A document is cut where that leaves no slack: whole sequences first,
then always the longest length ``capacity // j`` that the rest holds. All pieces of a class then have
the same length, a bin's offsets need no sums, and a bin wastes ``capacity % j`` at most.

A piece's place is its rank among all pieces of its class: its number within its task, counted while
encoding, plus the pieces of the tasks before. Bins that the last j - 1 pieces of a class would leave
open, fewer than ``capacity`` ids for each class whatever the input, are laid end to end instead and
cut at full sequences; what remains becomes sequences whose lengths are powers of two.

Defined cases: a null or empty text is the end id alone; rows that repeat a doc_id are packed one by
one; an empty table gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.operators.joins import join_lookup

from .common import blocks, chunk_encoder, saved
from .token_file import ENCODE_BYTES

_SCHEMA = "doc_id long, start long, length long, doc_tokens long, class int, part int, nth long, ids binary"


def cuts(rest: int, capacity: int) -> list[int]:
    """The lengths of the pieces of fewer ids than a sequence takes, each ``capacity // j``."""
    found = []
    while rest:
        j = capacity // rest
        found.append(rest if capacity // j == rest else capacity // (j + 1))
        rest -= found[-1]
    return found


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """The cut documents with their ids (little-endian unsigned 32-bit numbers), the class of each
    piece, and its number in the class among the pieces of its task."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = chunk_encoder(tokenizer_path)
        plans = [np.array(cuts(n, capacity), np.int64) for n in range(capacity)]
        seen = np.zeros(capacity + 1, np.int64)
        end = np.uint32(end_id).tobytes()
        for block in blocks(batches, ENCODE_BYTES):
            ids, counts = encoder.encode(block.column("text"))
            held = memoryview(ids.astype("<u4").tobytes())
            tokens = counts + 1
            planned = [np.concatenate([np.full(n // capacity, capacity, np.int64), plans[n % capacity]]) for n in tokens.tolist()]
            each = np.fromiter(map(len, planned), np.int64, len(planned))
            length = np.concatenate(planned)
            row = np.repeat(np.arange(len(tokens)), each)
            ends = np.cumsum(length)
            before = np.cumsum(tokens) - tokens
            start = ends - length - before[row]
            of_class = capacity // length
            order = np.argsort(of_class, kind="stable")
            sizes = np.bincount(of_class, minlength=capacity + 1)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            nth += seen[of_class]
            seen += sizes
            first = np.cumsum(counts) - counts
            low = 4 * (first[row] + start)
            high = 4 * (first[row] + np.minimum(start + length, counts[row]))
            last = start + length > counts[row]
            data = [bytes(held[a:b]) + end if z else bytes(held[a:b]) for a, b, z in zip(low.tolist(), high.tolist(), last.tolist(), strict=True)]
            columns = [block.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(tokens[row]), pa.array(of_class, pa.int32()), pa.array(np.full(len(row), part), pa.int32()), pa.array(nth), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "class", "part", "nth", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(per_task, _SCHEMA)


def _bounds(total: int, capacity: int) -> list[tuple[int, int]]:
    """Full sequences, then one for each power of two in what remains."""
    found = [(a, a + capacity) for a in range(0, total - total % capacity, capacity)]
    at = total - total % capacity
    for bit in reversed(range((total % capacity).bit_length())):
        if total % capacity >> bit & 1:
            found.append((at, at + (1 << bit)))
            at += 1 << bit
    return found


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset, ids: one row for each piece."""
    cut = saved(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    per_part = cut.groupBy("class", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_part.select("class", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    classes = {r["class"]: r["n"] for r in per_part.groupBy("class").agg(F.sum("n").alias("n")).collect()}  # about 2 * sqrt(capacity) rows
    first, bins = {}, 0
    for j, n in sorted(classes.items()):
        first[j], bins = bins, bins + n // j
    if not classes:
        return cut.select("doc_id", "start", "length", "doc_tokens", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids")
    by_class = F.create_map(*[F.lit(x) for j in classes for x in (j, first[j])])
    whole = F.create_map(*[F.lit(x) for j, n in classes.items() for x in (j, n - n % j)])
    ranked = join_lookup(cut, shift, ["class", "part"]).withColumn("rank", F.col("nth") + F.col("shift")).withColumn("in_bin", F.col("rank") < whole[F.col("class")])
    slot = F.floor(F.lit(capacity) / F.col("class")).cast("long")
    full = ranked.where("in_bin").select("doc_id", "start", "length", "doc_tokens", (by_class[F.col("class")] + F.floor(F.col("rank") / F.col("class"))).cast("long").alias("sequence_id"), (F.col("rank") % F.col("class") * slot).alias("offset"), "ids")
    # Fewer than `capacity` ids of each class remain, so these rows are few for any input.
    left = sum((n % j) * (capacity // j) for j, n in classes.items())
    if not left:
        return full
    at = dict(zip(sorted(classes), np.cumsum([0, *((classes[j] % j) * (capacity // j) for j in sorted(classes))]).tolist(), strict=False))
    begins = F.create_map(*[F.lit(x) for j in classes for x in (j, at[j])])
    bounds = F.array(*[F.struct(F.lit(bins + i).cast("long").alias("sequence_id"), F.lit(a).cast("long").alias("low"), F.lit(b).cast("long").alias("high")) for i, (a, b) in enumerate(_bounds(left, capacity))])
    line = ranked.where("not in_bin").withColumn("at", (begins[F.col("class")] + (F.col("rank") - whole[F.col("class")]) * slot).cast("long"))
    shared = line.select("*", F.explode(F.filter(bounds, lambda x: (x["high"] > F.col("at")) & (x["low"] < F.col("at") + F.col("length")))).alias("in"))
    low, high = F.greatest("at", "in.low"), F.least(F.col("at") + F.col("length"), F.col("in.high"))
    rest = shared.select("doc_id", (F.col("start") + low - F.col("at")).alias("start"), (high - low).alias("length"), "doc_tokens", "in.sequence_id", (low - F.col("in.low")).alias("offset"), F.expr("substring(ids, cast(4 * (greatest(at, in.low) - at) + 1 as int), cast(4 * (least(at + length, in.high) - greatest(at, in.low)) as int))").alias("ids"))
    return full.unionByName(rest)


def sequences(rows: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the packed sequences themselves, at most ``capacity`` ids each."""
    return (
        rows.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", "length", F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
    )
