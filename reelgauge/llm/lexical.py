"""Ranked lexical search: term-at-a-time with limited accumulators over shards of an inverted index.

A shard is one row of a stored table: the postings (term, document, frequency) of a block of texts.
An item's terms go rarest first. Each adds its part of the score to the documents of its postings,
and a document not met before gets an accumulator, as long as what the remaining terms can add at
most reaches the k-th score so far. From then on no new document can enter: the remaining terms only
update the accumulators that can still reach it, exactly. The k-th score is the better one of the
partial scores in the shard and of the shards that the task has searched before. A task keeps the k
best documents of each item, and these are merged.

Items are read in blocks of bounded size, each searched in one pass over the index; every pass meets
all documents. Term counts and lengths are sums over all documents.

Defined cases: null or empty texts have no term and are never found, nor are they counted; rows that
repeat a doc_id are documents of their own; a null doc_id comes last among equal scores; rows that
share an item_id are one item with the terms of all; an item without terms, or an empty table, gives
no rows. Columns besides doc_id and text, item_id and text, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, saved, sums, texts_of

#: Bytes of term text that one pass over the index takes, and shares that the tasks' results are
#: merged in first.
ITEM_BYTES, MERGE_SALTS = 8 << 20, 64
LAST = (1 << 63) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_APART = np.ones(256, bool)
_APART[48:58] = _APART[97:123] = _APART[128:] = False

_SHARD = "n_docs long, n_terms long, doc_ids binary, lengths binary, terms binary, term_ends binary, posting_ends binary, docs binary, counts binary"
_FOUND = "item long, known boolean, doc_id long, score long"


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Strings that lie end to end in ``data``."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
    """The text and the term number of each term in order, and the distinct terms."""
    data = _LOWER[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)]
    inside = ~_APART[data]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    starts, ends = edge[::2], edge[1::2]  # the last byte is a separator
    coded = _binary(data[inside], np.cumsum(ends - starts)).dictionary_encode()
    first = np.cumsum([0, *(len(x) + 1 for x in texts[:-1])]) if texts else np.zeros(0, np.int64)
    return np.searchsorted(first, starts, "right") - 1, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _shard(ids: np.ndarray, texts: list[bytes]) -> dict | None:
    text, term, terms = terms_of(texts)
    if not len(term):
        return None
    lengths = np.bincount(text, minlength=len(texts))
    there = np.flatnonzero(lengths)
    place = np.cumsum(lengths > 0) - 1
    pair, counts = np.unique(term * len(there) + place[text], return_counts=True)
    ends = np.cumsum(np.bincount(pair // len(there), minlength=len(terms)))
    sizes = pc.binary_length(terms).to_numpy()
    return {
        "n_docs": len(there), "n_terms": len(term), "doc_ids": ids[there].astype("<i8").tobytes(), "lengths": lengths[there].astype("<i8").tobytes(),
        "terms": b"".join(terms.to_pylist()), "term_ends": np.cumsum(sizes).astype("<i4").tobytes(), "posting_ends": ends.astype("<i8").tobytes(),
        "docs": (pair % len(there)).astype("<i4").tobytes(), "counts": counts.astype("<i4").tobytes(),
    }


def build_index(docs: DataFrame) -> DataFrame:
    """The stored inverted index, a row for each block of texts."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            ids = pc.fill_null(block.column("doc_id"), LAST).to_numpy(zero_copy_only=False)
            shard = _shard(ids, texts_of(block))
            if shard:
                yield pa.RecordBatch.from_pylist([shard], schema=_schema)

    _schema = pa.schema([(n, pa.int64() if n.startswith("n_") else pa.binary()) for n in (part.split()[0] for part in _SHARD.split(", "))])
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(F.length("text") > 0)
    return saved(rows.mapInArrow(per_batch, _SHARD), "lexical-index")


@dataclass(frozen=True)
class _Items:
    """A block of items: their ids, their terms by number, and the weight of each term; the terms of
    an item go from the rarest on."""

    ids: list[int | None]
    terms: list[bytes]
    of: list[np.ndarray]
    weights: np.ndarray


def _item_terms(items: DataFrame) -> DataFrame:
    """item_id and its distinct terms."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            text, term, terms = terms_of(texts_of(block))
            pair = np.unique(text * max(len(terms), 1) + term)
            yield pa.RecordBatch.from_arrays([block.column("item_id").take(pa.array(pair // max(len(terms), 1))), terms.take(pa.array(pair % max(len(terms), 1)))], names=["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(per_batch, "item_id long, term binary").distinct()


def _lookup(row: dict, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each term that the shard holds: its number among ``terms``, where its postings start and
    end."""
    own = _binary(np.frombuffer(row["terms"], np.uint8), np.frombuffer(row["term_ends"], "<i4"))
    at = pc.index_in(terms, value_set=own)
    there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    at = pc.fill_null(at, 0).to_numpy()[there]
    ends = np.frombuffer(row["posting_ends"], "<i8")
    return there, np.where(at > 0, ends[at - 1], 0), ends[at]


def _document_counts(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """Documents that hold each term."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms, pa.binary())
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                there, starts, ends = _lookup(row, wanted)
                total[there] += ends - starts
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["term", "n"])

    counts = index.select("terms", "term_ends", "posting_ends").mapInArrow(per_batch, "term long, n long").groupBy("term").agg(F.sum("n")).collect()  # a row for each term of the block of items
    df = np.zeros(len(terms), np.int64)
    for term, n in counts:
        df[term] = n
    return df


def impact(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to a document of length measure m that holds it so often."""
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def term_at_a_time(postings: list[tuple[np.ndarray, np.ndarray]], bounds: list[int], size: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard and their whole scores, all that can be among the k best.

    ``postings`` hold the documents (ascending) and the parts of the score of each term, rarest
    first; ``bounds`` the largest part of each; ``least`` a k-th score known before, 0 if none."""
    rest = np.concatenate([np.cumsum(bounds[::-1])[::-1], [0]])
    score = np.zeros(size, np.int64)
    at = 0
    while at < len(postings) and rest[at] >= least:
        docs, parts = postings[at]
        score[docs] += parts
        at += 1
        if at < len(postings) and rest[at] <= score.max():  # the k-th lies at most there
            least = max(least, _kth(score[score > 0], k))
    open_ = np.flatnonzero(score)
    found = score[open_]
    for i in range(at, len(postings)):
        competitive = found + rest[i] >= least
        open_, found = open_[competitive], found[competitive]
        docs, parts = postings[i]
        place = np.searchsorted(docs, open_).clip(max=len(docs) - 1)
        found += np.where(docs[place] == open_, parts[place], 0)
    return open_, found


def _search(items: _Items, n_docs: int, n_terms: int, k: int):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(items.terms, pa.binary())
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items.of]
        for batch in batches:
            for row in batch.to_pylist():
                there, starts, ends = _lookup(row, wanted)
                ids, lengths = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
                all_docs, all_counts = np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["counts"], "<i4")
                m = 100 - 90 + (90 * lengths * n_docs) // n_terms
                where = np.full(len(items.terms), -1)
                where[there] = np.arange(len(there))
                postings = []
                for term, low, high in zip(there, starts, ends, strict=True):
                    docs = all_docs[low:high].astype(np.int64)
                    postings.append((docs, items.weights[term] * impact(all_counts[low:high].astype(np.int64), m[docs])))
                bounds = [int(parts.max()) for _, parts in postings]
                for i, terms in enumerate(items.of):
                    held = where[terms]
                    held = held[held >= 0]
                    if not len(held):
                        continue
                    known = best[i]
                    least = int(known[1][-1]) if len(known[1]) == k else 0
                    found, score = term_at_a_time([postings[x] for x in held], [bounds[x] for x in held], len(ids), k, least)
                    found, score = found[score >= max(least, 1)], score[score >= max(least, 1)]
                    if len(found):
                        docs, scores = np.concatenate([known[0], ids[found]]), np.concatenate([known[1], score])
                        order = np.lexsort((docs, -scores))[:k]
                        best[i] = docs[order], scores[order]
        for i, (docs, scores) in enumerate(best):
            if len(docs):
                name = items.ids[i]
                yield pa.RecordBatch.from_arrays([pa.array([name or 0] * len(docs), pa.int64()), pa.array([name is not None] * len(docs)), pa.array(docs), pa.array(scores)], names=["item", "known", "doc_id", "score"])

    return per_batch


def search(index: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each item
    (item_id, text), equal scores by ascending doc_id."""
    spark = index.sparkSession
    terms = saved(_item_terms(items), "item-terms")
    size = terms.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    passes = 1 + size // item_bytes
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    found = None
    for nth in range(passes if n_docs else 0):
        some = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == nth).groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()  # about item_bytes of terms
        names = sorted({bytes(t) for row in some for t in row["terms"]})
        if not names:
            continue
        df = _document_counts(index, names)
        number = {t: i for i, t in enumerate(names)}
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        of = [np.array(sorted((number[bytes(t)] for t in row["terms"]), key=lambda i: (df[i], i)), np.int64) for row in some]
        of = [x[df[x] > 0] for x in of]
        part = index.mapInArrow(_search(_Items([row["item_id"] for row in some], names, of, weights), n_docs, n_terms, k), _FOUND)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    name, doc = F.when(F.col("known"), F.col("item")).alias("item_id"), F.when(F.col("doc_id") != LAST, F.col("doc_id")).alias("doc_id")
    rows = saved(found.select("item", "known", "doc_id", "score", (F.spark_partition_id() % MERGE_SALTS).alias("salt")), "lexical-found")
    for group in (["item", "known", "salt"], ["item", "known"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "doc_id"))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= k)
    return rows.select(name, "rank", doc, "score")
