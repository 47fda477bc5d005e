"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function orders all shingles; a sketch is the k smallest of a document's set. Documents with
equal sets form a class and go on as one. Sketch values that two classes share
make inverted lists. A class with fewer shared values than a link needs has no partner and leaves; of
the others only the rarest values, of which any partner must hold one, stay in the lists. The first
members of each list meet all others that are not yet in their component; the union sketch's estimate
filters the pairs, and the full sets confirm them. So a large group of near copies costs a few pairs
for each member.

Members of lists that are not one component by then get sketches of WIDE values, which hold most of
their sets whole: their lists hold what a link needs at least, by exact bounds, and a passage that many
documents share stays out of them; parity bits of the sets bound how far two of them differ. The first members meet all others again, eight times as many in
each round, until every list is one component or used up. No pair of different texts that matters
is left out.

A link needs a Jaccard similarity of 0.75. Its overlap of two sketches has a mean of 48 of k = 64 and a
standard deviation of 3.5 (768 and 14 for 1024); lists and estimates ask for 32 (704), more than 4.5
deviations below.

Defined cases: null, empty and blank texts have no shingles and link with nothing; fewer than five words
make one shingle; rows that repeat a doc_id count as one document; rows without doc_id get no component
and are kept; an empty table gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.operators import joins

from .common import blocks, saved
from .components import components

SHINGLE = 5
K = 64
SHARE, OF = 75, 100
#: The part of k that a link's sketches must share.
OVERLAP = 0.5
#: The size of the sketches of the classes that one round leaves open, and their part.
WIDE, WIDE_OVERLAP = 1024, 0.6875
#: Parity bits of a set.
BITS = 1024
#: Members of a list that meet all others in a first round.
HUBS = 2


#: Lookups above this size are shuffled: they grow with the table, and no join should turn from one
#: way to the other where it costs most.
BROADCAST_BYTES = 2 << 20


#: The limit for the classes of several copies: narrow rows, met by all sketches.
COPIES_BYTES = 64 << 20


def join_lookup(big: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    return joins.join_lookup(big, lookup, on, how, limit_bytes=BROADCAST_BYTES)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signed(x: np.ndarray) -> np.ndarray:
    """Hashes as signed numbers; flipping the top bit keeps their order."""
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in ascending order, end to end, and where each
    text's begin, with the end of the last."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    counts = np.diff(split.offsets.to_numpy())
    coded = split.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    row = np.repeat(np.arange(len(counts)), counts)
    index = coded.indices.to_numpy()
    real = np.array([bool(w) for w in names], bool)[index]
    row, word = row[real], hashes[index[real]]
    n = np.bincount(row, minlength=len(counts))
    start = np.cumsum(n) - n
    if len(word) < SHINGLE:
        word = np.pad(word, (0, SHINGLE - len(word)))
        row = np.pad(row, (0, SHINGLE - len(row)), constant_values=-1)
    value = np.zeros(len(word) - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + word[i:len(word) - SHINGLE + 1 + i])
    full = (row[:len(value)] == row[SHINGLE - 1:]) & (row[:len(value)] >= 0)
    found, owner = value[full], row[:len(value)][full]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        more = np.zeros(len(short), np.uint64)
        for i in range(SHINGLE - 1):
            here = n[short] > i
            more[here] = _mixed(more[here] * np.uint64(0x9E3779B97F4A7C15) + word[start[short[here]] + i] + np.uint64(1))
        found, owner = np.concatenate([found, more]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    if len(found):
        new = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))
        found, owner = found[new], owner[new]
    starts = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(counts)), out=starts[1:])
    return found, starts


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_shingles, set_1 and set_2 (together equal for equal sets only), sketch."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found, starts = shingles(block.column("text"))
            n = np.diff(starts)
            prefix = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (found, _mixed(found + np.uint64(1)))]
            sums = [(x[starts[1:]] - x[starts[:-1]]).view(np.int64) for x in prefix]
            kept = np.minimum(n, k)
            ends = np.cumsum(kept)
            take = np.repeat(starts[:-1] - (ends - kept), kept) + np.arange(int(ends[-1]))
            values = _signed(found[take])
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(n), pa.array(sums[0]), pa.array(sums[1]), lists], names=["doc_id", "n_shingles", "set_1", "set_2", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(per_batch, "doc_id long, n_shingles long, set_1 long, set_2 long, sketch array<long>")


def full_sets(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, sketch, shingles (all hashes of the set, ascending, as bytes)."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found, starts = shingles(block.column("text"))
            sets = [found[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            signed = [_signed(x[:k]) for x in sets]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(signed, pa.list_(pa.int64())), pa.array([x.tobytes() for x in sets], pa.binary())], names=["doc_id", "sketch", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(per_batch, "doc_id long, sketch array<long>, shingles binary")


def _needs(k: int, exact: bool) -> tuple[str, str]:
    """How many values of its sketch a class shares with any partner, and with a larger one.

    Sketches that hold whole sets, also those of all possible partners, allow exact bounds: a link
    shares 3/4 of either set, and 6/7 of the smaller one. Others leave room for chance.
    """
    if not exact:
        half = f"ceil({OVERLAP} * least(n, {k}))"
        return half, half
    chance = f"ceil({WIDE_OVERLAP} * least(n, {k}))"
    return f"if(4 * n <= 3 * {k}, (3 * n + 3) div 4, {chance})", f"if(4 * n <= 3 * {k}, (6 * n + 6) div 7, {chance})"


def inverted_lists(classes: DataFrame, k: int = K, exact: bool = False, rounds: int = 3) -> DataFrame:
    """value, node, n, first: the rarest values of each class, one of which any partner holds too;
    ``first`` marks those that a larger partner holds one of. ``classes``: node, n, sketch.

    Every round drops the values of one class and the classes that then share too few.
    """
    need, need_larger = _needs(k, exact)
    rows = classes.select("node", "n", F.explode("sketch").alias("value"))
    for _ in range(rounds):
        often = saved(rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "shared-values")
        shared = join_lookup(rows, often, "value")
        enough = shared.groupBy("node", "n").agg(F.collect_list(F.struct("df", "value")).alias("held")).where(f"size(held) >= {need}")  # at most k values
        held = saved(enough, "sharing-classes")
        rows = held.select("node", "n", F.explode("held.value").alias("value"))
    return (
        held.select("node", "n", F.size("held").alias("size"), F.posexplode(F.array_sort("held")).alias("at", "one"))
        .where(f"at <= size - {need}")
        .select(F.col("one.value").alias("value"), "node", "n", F.expr(f"at <= size - {need_larger}").alias("first"))
    )


def _wide_sketches(sets: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """node, n, sketch of k values, and parity bits of the full sets of some nodes: bit i tells
    whether an odd number of hashes falls on i, so that two sets differ in more hashes than bits."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
            signed = [_signed(x[:k]) for x in held]
            bits = [np.packbits(np.bincount((x >> np.uint64(20)) % np.uint64(BITS), minlength=BITS).astype(np.uint8) & 1).view(np.int64) for x in held]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(map(len, held)), pa.int64()), pa.array(signed, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], names=["node", "n", "sketch", "bits"])

    chosen = join_lookup(sets.select("doc_id", "shingles"), nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    return chosen.mapInArrow(per_batch, "node long, n long, sketch array<long>, bits array<long>")


def _estimated(pairs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The pairs whose union sketch holds enough common values."""
    a, b = (classes.select(F.col("node").alias(x), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
    met = join_lookup(join_lookup(pairs, a, "a"), b, "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    return met.where(common >= OVERLAP * F.size(union)).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a, b = (sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
    met = join_lookup(join_lookup(pairs, a, "a"), b, "b")

    def per_batch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            linked = []
            for x, y in zip(part["set_a"], part["set_b"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(OF * both >= SHARE * (len(x) + len(y) - both))
            yield part.loc[linked, ["a", "b"]]

    return met.mapInPandas(per_batch, "a long, b long").distinct()


def links(docs: DataFrame, classes: DataFrame, k: int = K) -> DataFrame | None:
    """node, component of the classes that link with another; None if no class does."""
    lists = saved(inverted_lists(classes, k), "inverted-lists")
    active = lists.select("node").distinct()
    if lists.limit(1).count() == 0:
        return None
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = saved(full_sets(join_lookup(chosen, active.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi"), k), "full-sets")
    held = sets.select(F.col("doc_id").alias("node"), "sketch")
    lists, found = _met(_labelled(lists, None), None, held, sets, k, HUBS)
    left = _open(lists).select("node").distinct()
    wide = saved(_wide_sketches(sets, left, WIDE), "wide-sketches")
    lists = saved(inverted_lists(wide, WIDE, exact=True), "inverted-lists")
    lists = _open(_labelled(join_lookup(lists, wide.select("node", "bits"), "node"), found))
    hubs = HUBS
    while lists.limit(1).count():
        lists, found = _met(lists, found, held, sets, k, hubs)
        lists = _open(lists)
        hubs *= 8
    return found


def _labelled(lists: DataFrame, found: DataFrame | None) -> DataFrame:
    """The lists with each member's component, so far."""
    lists = lists.drop("component")
    if found is None:
        return lists.withColumn("component", F.col("node"))
    return lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open(lists: DataFrame) -> DataFrame:
    """The lists whose members are not yet in one component."""
    mixed = lists.groupBy("value").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("value")
    return saved(lists.join(mixed, "value", "left_semi"), "open-lists")


def _met(lists: DataFrame, found: DataFrame | None, held: DataFrame, sets: DataFrame, k: int, hubs: int) -> tuple[DataFrame, DataFrame | None]:
    """The first members of each list, its hubs, meet all others; the lists without these hubs, and
    all components."""
    nth = F.row_number().over(Window.partitionBy("value").orderBy("node"))
    hub = lists.withColumn("nth", nth).where(F.col("nth") <= hubs).drop("nth")
    hub = saved(hub.select("value", F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in hub.columns if c not in ("value", "node")]), "hubs")
    met = join_lookup(lists.withColumnRenamed("node", "b"), hub, "value")
    alike = (OF * F.least("n", "n_a") >= SHARE * F.greatest("n", "n_a")) & (F.col("component") != F.col("component_a"))
    smaller_first = (F.col("first") & (F.col("n") <= F.col("n_a"))) | (F.col("first_a") & (F.col("n_a") <= F.col("n")))
    alike = (F.col("a") < F.col("b")) & alike & smaller_first
    if "bits" in lists.columns:  # a link's sets differ in a seventh of their sizes at most
        differ = reduce(add, (F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("bits_a")[i])) for i in range(BITS // 64)))
        alike &= 7 * differ <= F.col("n") + F.col("n_a")
    pairs = saved(met.where(alike).select("a", "b").distinct(), "pairs")
    likely = saved(_estimated(pairs, held, k), "likely-pairs")
    if "bits" in lists.columns:  # after the first round few sets are still asked for
        asked = saved(likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "asked-sets")
        sets = saved(join_lookup(sets, asked, "doc_id", "left_semi").select("doc_id", "shingles"), "asked-sets")
    fresh = saved(_confirmed(likely, sets), "links")
    if fresh.limit(1).count():
        known = fresh if found is None else found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(fresh)
        found = saved(components(known), "components")
    done = hub.groupBy("value").agg(F.max("a").alias("until"))
    return _labelled(join_lookup(lists, done, "value").where("node > until").drop("until"), found), found


def near_duplicates(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each document. Nodes are the smallest
    doc_id of each class."""
    known = saved(sketches(docs, k).withColumn("row", F.monotonically_increasing_id()), "sketches")
    same = ["set_1", "set_2", "n_shingles"]
    usable = known.where("n_shingles > 0 and doc_id is not null")
    least = F.min(F.struct("doc_id", "row"))
    grouped = saved(usable.groupBy(*same).agg(least.alias("least"), F.count("*").alias("copies")).select(*same, F.col("least.doc_id").alias("node"), F.col("least.row").alias("first_row"), "copies"), "classes")
    # Sketches stay where they are: only rows of classes with several copies are looked up.
    several = grouped.where("copies > 1").select(*same, "first_row")
    single = joins.join_lookup(usable, several, same, "left", limit_bytes=COPIES_BYTES).where("first_row is null or first_row = row")
    classes = single.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sketch")
    found = links(docs, classes, k)
    moved = grouped.select(*same, "node", "copies")
    if found is None:
        moved = moved.withColumn("component_id", F.col("node")).where("copies > 1")
    else:
        moved = moved.join(found, "node", "left").withColumn("component_id", F.coalesce("component", "node")).where("copies > 1 or component is not null")
    moved = saved(moved.select(*same, "component_id"), "moved-classes")
    return join_lookup(known.select("doc_id", *same), moved, same, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
