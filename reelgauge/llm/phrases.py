"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

Every word starts a suffix, which ends with its piece or after three words. A task counts the equal
suffixes of its block of texts and sends them, packed, to the bucket of their leading words: of the
first one, of the first two where the first word is frequent, of all three where the pair is. The
bucket's pointers are sorted by three-way partition, word after word: the weight of an equal partition
is the count of its phrase over all documents, and a partition below the least count is abandoned
with everything in it. All open partitions of a bucket are split in one pass of array operations.

Buckets hold about BUCKET_WORDS suffixes however large the table is. Which words and pairs are
frequent decides only where suffixes go: at most 1 / HOT_SHARE of each can be, pairs are looked for
at every SAMPLE-th word, and counts are exact either way.

Defined cases: null lang is ``und``; null or empty texts have no words; repeated rows count one by
one; ties go by the phrase's bytes; an empty table gives no rows. Columns besides text and lang are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, saved, texts_of

LEAST, LONGEST, TOP, COVERED = 10, 3, 2000, 50
BUCKET_WORDS, HOT_SHARE, SAMPLE = 1 << 18, 1 << 17, 64
RANK_SALTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _BREAK.copy()
_APART[list(b" \t")] = True


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.BinaryArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.BinaryArray]:
    """Text, piece and word number of each word in order, and the distinct words."""
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    inside = ~_APART[data]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    starts, ends = edge[::2], edge[1::2]
    coded = _strings(data[inside], ends - starts).dictionary_encode()
    first = np.cumsum([0, *(len(x) + 1 for x in texts[:-1])]) if texts else np.zeros(0, np.int64)
    piece = np.cumsum(_BREAK[data])[starts]
    return np.searchsorted(first, starts, "right") - 1, piece, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _block(block: pa.RecordBatch):
    """Language, word, second and third word (-1: none) of every suffix, distinct languages and
    words."""
    langs = pc.fill_null(block.column("lang"), "und").dictionary_encode()
    text, piece, word, words = words_of(texts_of(block))
    lang = langs.indices.to_numpy().astype(np.int64)[text]
    second, third = np.full(len(word), -1), np.full(len(word), -1)
    second[:-1] = np.where(piece[1:] == piece[:-1], word[1:], -1)
    third[:-2] = np.where(piece[2:] == piece[:-2], word[2:], -1)
    return lang, word, second, third, langs.dictionary, words


def _joined(words: pa.BinaryArray, *columns: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in columns), pa.scalar(b" ", pa.binary()))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all words, and of the pairs at every SAMPLE-th word."""
    for block in blocks(batches):
        lang, word, second, _, langs, words = _block(block)
        n = len(words)
        one, often = np.unique(lang * n + word, return_counts=True)
        some = np.flatnonzero(second >= 0)[::SAMPLE]
        two, pairs = np.unique((lang[some] * n + word[some]) * n + second[some], return_counts=True)
        for key, count, names in ((one // max(n, 1), often, words.take(pa.array(one % max(n, 1)))), (two // max(n * n, 1), pairs, _joined(words, two // max(n, 1) % max(n, 1), two % max(n, 1)))):
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(key)), names.cast(pa.string()), pa.array(count.astype(np.int64))], names=["lang", "phrase", "n"])


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _routed(buckets: int, hot_words: set[tuple[str, bytes]], hot_pairs: set[tuple[str, bytes]]):
    """Rows (lang, whole, bucket, suffixes, counts) of each block. A suffix is three words, each
    followed by a blank, the last by a line end. Suffixes of a frequent pair are not ``whole``: their
    bucket holds one third word only, and the pair is counted by a suffix of its own."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            lang, word, second, third, langs, words = _block(block)
            some = second >= 0
            n = len(words)
            pair, which = np.unique((lang[some] * n + word[some]) * n + second[some], return_inverse=True)
            triple, count = np.unique(which * (n + 1) + third[some] + 1, return_counts=True)
            if not len(triple):
                continue
            of = triple // (n + 1)
            l, a, b, c = pair[of] // (n * n), pair[of] // n % n, pair[of] % n, triple % (n + 1) - 1
            names, tongues = words.to_pylist(), langs.to_pylist()
            hot = np.zeros(len(pair), np.int8)  # 1: by the pair, 2: by the suffix
            if hot_words:
                led = np.array([[(t, w) in hot_words for w in names] for t in tongues])
                hot[led[pair // (n * n), pair // n % n]] = 1
                for i in np.flatnonzero(hot):
                    if (tongues[pair[i] // (n * n)], names[pair[i] // n % n] + b" " + names[pair[i] % n]) in hot_pairs:
                        hot[i] = 2
            whole = np.ones(len(triple), bool)
            whole[hot[of] == 2] = False
            own = np.flatnonzero(hot == 2)  # frequent pairs count for themselves
            total = np.bincount(of, count, len(pair)).astype(np.int64)
            l, a, b, c = (np.concatenate(x) for x in ((l, pair[own] // (n * n)), (a, pair[own] // n % n), (b, pair[own] % n), (c, np.full(len(own), -1))))
            by = np.concatenate([hot[of], np.ones(len(own), np.int8)])
            count, whole = np.concatenate([count, total[own]]), np.concatenate([whole, np.ones(len(own), bool)])
            code = np.array([xxhash.xxh64_intdigest(w) for w in names] + [0], np.uint64)
            unit = _mixed(np.array([xxhash.xxh64_intdigest(t) for t in tongues], np.uint64)[l], code[a])
            unit = np.where(by >= 1, _mixed(unit, code[b]), unit)
            unit = np.where(by >= 2, _mixed(unit, code[c]), unit)
            bucket = (unit % np.uint64(buckets)).astype(np.int64)
            group = (bucket * len(tongues) + l) * 2 + whole
            order = np.argsort(group, kind="stable")
            cut = np.concatenate([[0], np.flatnonzero(np.diff(group[order])) + 1, [len(order)]])
            last = pa.array([w + b"\n" for w in names] + [b"\n"], pa.binary())
            text = pc.binary_join_element_wise(words.take(pa.array(a[order])), words.take(pa.array(b[order])), last.take(pa.array(c[order] % (n + 1))), pa.scalar(b" ", pa.binary()))
            offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1]
            row = lambda x: pa.array(x[order][cut[:-1]])
            blobs = pa.BinaryArray.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets[cut])), text.buffers()[2]])
            counts = pa.BinaryArray.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * 8).astype(np.int32)), pa.py_buffer(count[order].astype("<i8"))])
            yield pa.RecordBatch.from_arrays([langs.take(row(l)), row(whole), row(bucket), blobs, counts], names=["lang", "whole", "bucket", "suffixes", "counts"])

    return per_batch


def equal_partitions(keys: np.ndarray, weights: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, length, weight) of the prefixes of ``keys`` (row x symbol) that weigh ``least`` at
    least; the row is one that has the prefix.

    Multikey quicksort: each open partition takes the symbol of its middle pointer at its depth and
    splits into less, equal and greater; the equal part goes on with the next symbol."""
    pointers = np.arange(len(keys))
    starts, depth = np.zeros(min(len(keys), 1), np.int64), np.zeros(min(len(keys), 1), np.int64)
    found = []
    while len(starts):
        sizes = np.diff(np.append(starts, len(pointers)))
        part = np.repeat(np.arange(len(starts)), sizes)
        symbol = keys[pointers, depth[part]]
        middle = starts + sizes // 2
        side = np.sign(symbol - symbol[middle][part]) + 1
        label = part * 3 + side
        many = np.bincount(label, minlength=3 * len(starts))
        weight = np.bincount(label, weights[pointers], 3 * len(starts)).astype(np.int64)
        inner = np.tile([0, 1, 0], len(starts))
        deeper = np.repeat(depth, 3) + inner
        heavy = (weight >= least) & (many > 0)
        # Where each pointer goes: partition after partition, the three sides in order.
        first = np.cumsum(many) - many
        place = np.empty(len(pointers), np.int64)
        for s in range(3):
            here = np.flatnonzero(side == s)
            mine = many[s::3]
            place[here] = np.arange(len(here)) - np.repeat(np.cumsum(mine) - mine, mine) + np.repeat(first[s::3], mine)
        moved = np.empty_like(pointers)
        moved[place] = pointers
        equal = np.flatnonzero(heavy & (inner == 1))
        found.append((moved[first[equal]], deeper[equal], weight[equal]))
        goes_on = heavy & (deeper < keys.shape[1])
        pointers = moved[np.repeat(goes_on, many)]
        left = many[goes_on]
        starts, depth = np.cumsum(left) - left, deeper[goes_on]
    return found


def _counted(least: int):
    """Phrases of two and three words of each bucket, with their counts. Rows come bucket by
    bucket."""

    def result(rows: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
        weights = np.frombuffer(b"".join(r[3] for r in rows), "<i8")
        apart = (data == 32) | (data == 10)
        ends = np.flatnonzero(apart)
        coded = _strings(data[~apart], np.diff(ends, prepend=-1) - 1).dictionary_encode()
        langs = sorted({r[0] for r in rows})
        lead = np.repeat([langs.index(r[0]) * 2 + r[1] for r in rows], [len(r[3]) // 8 for r in rows])
        keys = np.column_stack([lead, coded.indices.to_numpy().reshape(-1, LONGEST)]).astype(np.int32)
        row, length, weight = (np.concatenate(x) for x in zip(*equal_partitions(keys, weights, least), strict=True))
        none = pc.index(coded.dictionary, pa.scalar(b"", pa.binary())).as_py()
        three = (length == 4) & (keys[row, 3] != none)
        two = (length == 3) & (keys[row, 0] % 2 == 1)
        names = pa.concat_arrays([_joined(coded.dictionary, *(keys[row[some], i] for i in range(1, n + 1))) for n, some in ((2, two), (3, three))])
        rows_ = np.concatenate([row[two], row[three]])
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(keys[rows_, 0] // 2)), names.cast(pa.string()), pa.array(np.concatenate([weight[two], weight[three]]))], names=["lang", "phrase", "n"])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        bucket = None
        for batch in batches:
            for at, lang, whole, suffixes, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lang", "whole", "suffixes", "counts")), strict=True):
                if at != bucket and rows:
                    yield result(rows)
                    rows = []
                bucket = at
                rows.append((lang, whole, suffixes, counts))
        if rows:
            yield result(rows)

    return per_batch


def phrase_counts(docs: DataFrame, least: int = LEAST, bucket_words: int = BUCKET_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all words, and of all phrases of two or three words found ``least``
    times; both are stored."""
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    seen = rows.mapInArrow(_word_counts, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    seen = saved(seen, "word-counts")
    is_pair = F.contains(F.col("phrase"), F.lit(" "))
    words = seen.where(~is_pair)
    total = words.agg(F.sum("n")).first()[0] or 0
    often = max(bucket_words // 16, total // HOT_SHARE)
    hot = seen.where(F.col("n") * F.when(is_pair, SAMPLE).otherwise(1) > often).collect()  # at most HOT_SHARE words and about as many pairs
    hot_words = {(r["lang"], r["phrase"].encode()) for r in hot if " " not in r["phrase"]}
    hot_pairs = {(r["lang"], r["phrase"].encode()) for r in hot if " " in r["phrase"]}
    dealt = rows.mapInArrow(_routed(1 + total // bucket_words, hot_words, hot_pairs), "lang string, whole boolean, bucket long, suffixes binary, counts binary")
    counted = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_counted(least), "lang string, phrase string, n long")
    return words, saved(counted, "phrase-counts")


def _score(a: str, l: str, r: str):
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * F.col(a).cast("decimal(20,0)") * F.col(a).cast("decimal(20,0)"), wide(l) * wide(r))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase's score is that of its worst cut. A phrase goes where a longer one that holds it is
    found at least ``covered`` times for each hundred of its own."""
    words, phrases = phrase_counts(docs, least, bucket_words)
    parts = phrases.unionByName(words.where(F.col("n") >= least)).select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("f"))
    cuts = F.expr("transform(sequence(1, size(w) - 1), k -> struct(k, array_join(slice(w, 1, k), ' ') as left, array_join(slice(w, k + 1, size(w)), ' ') as right))")
    cut = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w")).select("lang", "phrase", "a", F.inline(cuts))
    with_l = cut.join(parts.withColumnRenamed("f", "l"), (F.col("lang") == F.col("of")) & (F.col("left") == F.col("part"))).drop("of", "part")
    with_r = with_l.join(parts.withColumnRenamed("f", "r"), (F.col("lang") == F.col("of")) & (F.col("right") == F.col("part"))).drop("of", "part")
    worst = with_r.groupBy("lang", "phrase", "a").agg(F.min(F.struct(_score("a", "l", "r").alias("score"), "k", "l", "r")).alias("m"))
    longer = phrases.withColumn("w", F.split("phrase", " ")).where(F.size("w") == LONGEST).select("lang", F.explode(F.expr("array(array_join(slice(w, 1, 2), ' '), array_join(slice(w, 2, 2), ' '))")).alias("part"), F.col("n").alias("f"))
    around = longer.groupBy(F.col("lang").alias("of"), "part").agg(F.max("f").alias("f"))
    held = worst.join(around, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")), "left")
    rated = saved(held.where(F.col("f").isNull() | (100 * F.col("f") < covered * F.col("a"))).select("lang", "phrase", "a", "m.l", "m.r", "m.score"), "rated-phrases")
    rated = rated.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    for group in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase"))
        rated = rated.withColumn("rank", rank).where(F.col("rank") <= top)
    sizes = words.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("n"))
    return rated.join(sizes, F.col("lang") == F.col("of")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
