"""Exact top-k inner products by MaxScore over shards of integer vectors.

A component is a term, the rows with a non-zero value of it are its postings, and the largest product
with the query's value is its score bound. Terms whose bounds together stay below the k-th score so
far are non-essential: a row in none of the essential postings of products above zero cannot enter.
The others are scored over the essential terms and probed term by term, the largest bound first, as
long as their score plus the bounds still open reaches the k-th score.

Candidates lie in shards of bounded size. A shard is traversed in blocks with bounds of their own, the
rows of greatest length first; after each block the k-th score rises and the essential terms are
found anew. A task takes its k-th scores from shard to shard, and begins with those of a first round
over one shard. Queries come in groups of bounded size, each one pass over the shards; a task keeps
the k best rows of each query, and these are merged.

Defined cases: vectors null, or holding null or non-finite components, take no part; shorter vectors
count as padded with zeros; repeated vec_ids are rows of their own, but a query's own vec_id is never
its result; fewer than k candidates give all of them; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, saved

SCALE = 1024
SHARD_ROWS, BLOCK_ROWS = 4096, 512
#: Bytes of query vectors that one pass over the shards takes, and shares in which the tasks' results
#: are merged first.
QUERY_BYTES, MERGE_SALTS = 16 << 20, 64
#: Terms probed between two looks at the k-th score, and queries that traverse a block together.
STEP, QUERY_ROWS = 8, 512
#: The k-th score of a query with fewer rows.
NONE = np.iinfo(np.int64).min

_SHARD = "width int, ids binary, matrix binary"


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of each component of the usable vectors."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~bad)
    return usable.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x)).alias("vector"))


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    matrix = np.zeros((len(vectors), max(map(len, vectors), default=0)), "<i8")
    for i, v in enumerate(vectors):
        matrix[i, :len(v)] = v
    return matrix


def shards_of(rows: DataFrame, size: int = SHARD_ROWS) -> DataFrame:
    """width, ids, matrix: at most ``size`` vectors a row, the longest first."""

    def per_batch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), size):
                some = part.iloc[at:at + size]
                matrix = _matrix(list(some["vector"]))
                order = np.argsort(-np.square(matrix.astype(float)).sum(1), kind="stable")
                yield pd.DataFrame({"width": [matrix.shape[1]], "ids": [some["vec_id"].to_numpy("<i8")[order].tobytes()], "matrix": [matrix[order].tobytes()]})

    return saved(rows.mapInPandas(per_batch, _SHARD), "vector-shards")


class Best:
    """The k best rows of each query so far by query, the best first, ties to smaller ids."""

    def __init__(self, queries: int, k: int):
        self.queries, self.k = queries, k
        self.query = self.ids = self.scores = np.zeros(0, np.int64)

    def least(self) -> np.ndarray:
        """The k-th score of each query, NONE where there are fewer rows."""
        counts = np.bincount(self.query, minlength=self.queries)
        least = np.full(self.queries, NONE)
        least[counts == self.k] = self.scores[np.cumsum(counts)[counts == self.k] - 1]
        return least

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        query, ids, scores = (np.concatenate(x) for x in ((self.query, query), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, query))
        query = query[order]
        first = np.arange(len(query)) - np.searchsorted(query, query) < self.k
        self.query, self.ids, self.scores = query[first], ids[order[first]], scores[order[first]]


def traverse(queries: np.ndarray, block: np.ndarray, high: np.ndarray, low: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of all rows of a block that reach their query's ``least``, which is NONE
    where all do. ``high`` and ``low`` are the components' extremes over the rows, zero included.

    All queries traverse their essential terms in one product, the other terms' values set to zero;
    the rows still competitive are probed in the rest, each query's own terms in its own order.
    """
    bounds = np.maximum(queries * high, queries * low)
    terms = np.argsort(-bounds, axis=1, kind="stable")
    width = terms.shape[1]
    open_ = np.zeros((len(queries), width + 1), bounds.dtype)  # bound of the terms from i on
    open_[:, :-1] = np.cumsum(np.take_along_axis(bounds, terms, 1)[:, ::-1], 1)[:, ::-1]
    # The terms from ``essential`` on stay below the k-th score together.
    essential = np.minimum((open_ >= least[:, None]).sum(1), width)
    rank = np.empty_like(terms)
    np.put_along_axis(rank, terms, np.arange(width)[None, :], 1)
    score = np.where(rank < essential[:, None], queries, 0) @ block.T
    query, row = np.nonzero(score + open_[np.arange(len(queries)), essential][:, None] >= least[:, None])
    score, at = score[query, row], essential[query]
    # Terms beyond the last one are a component of zeros.
    terms = np.pad(terms, ((0, 0), (0, STEP)), constant_values=width)
    queries, block = np.pad(queries, ((0, 0), (0, 1))), np.pad(block, ((0, 0), (0, 1)))
    while (at < width).any():
        some = terms[query[:, None], np.minimum(at, width)[:, None] + np.arange(STEP)]
        score = score + (queries[query[:, None], some] * block[row[:, None], some]).sum(1)
        at = np.minimum(at + STEP, width)
        competitive = score + open_[query, at] >= least[query]
        query, row, score, at = query[competitive], row[competitive], score[competitive], at[competitive]
    return query, row, score


def max_score(query: np.ndarray, block: np.ndarray, high: np.ndarray, low: np.ndarray, least: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block and their scores for one query, all that reach ``least``."""
    _, rows, scores = traverse(query[None, :], block, high, low, np.array([NONE if least is None else least]))
    return rows, scores


def _exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """Doubles hold all sums exactly where they stay below 2 ** 53, and are multiplied faster."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return np.float64 if most < 1 << 53 else np.int64


def _search(query_ids: np.ndarray, queries: np.ndarray, k: int, known: np.ndarray | None = None):
    """``known``: a k-th score for each query from an earlier round, NONE if there is none."""
    known = np.full(len(queries), NONE) if known is None else known
    groups = [(at, min(at + QUERY_ROWS, len(queries))) for at in range(0, len(queries), QUERY_ROWS)]

    def per_batch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [Best(end - begin, k) for begin, end in groups]
        for part in parts:
            for row in part.itertuples(index=False):
                ids = np.frombuffer(row.ids, "<i8")
                matrix = np.frombuffer(row.matrix, "<i8").reshape(len(ids), row.width)
                width = max(row.width, queries.shape[1])
                kind = _exact_type(matrix, queries)
                matrix = np.pad(matrix, ((0, 0), (0, width - row.width))).astype(kind)
                wanted = np.pad(queries, ((0, 0), (0, width - queries.shape[1]))).astype(kind)
                for at in range(0, len(ids), BLOCK_ROWS):
                    block, some = matrix[at:at + BLOCK_ROWS], ids[at:at + BLOCK_ROWS]
                    high, low = block.max(0, initial=0), block.min(0, initial=0)
                    for group, (begin, end) in zip(best, groups, strict=True):
                        least = np.maximum(group.least(), known[begin:end])
                        query, rows, scores = traverse(wanted[begin:end], block, high, low, least)
                        other = some[rows] != query_ids[begin:end][query]
                        if other.any():
                            group.add(query[other], some[rows[other]], scores[other].astype(np.int64))
        for group, (begin, end) in zip(best, groups, strict=True):
            if len(group.ids):
                yield pd.DataFrame({"query_id": query_ids[begin:end][group.query], "vec_id": group.ids, "score": group.scores})
        give_back()

    return per_batch


_FOUND = "query_id long, vec_id long, score long"


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: both tables hold vec_id and vector (integers). Queries with
    the same vec_id are searched once."""
    spark = vectors.sparkSession
    shards = shards_of(vectors)
    asked = saved(queries.dropDuplicates(["vec_id"]), "queries")
    passes = 1 + (asked.agg(F.sum(8 * F.size("vector") + 16)).first()[0] or 0) // query_bytes
    found = None
    for nth in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == nth).collect()  # about query_bytes
        if not rows:
            continue
        ids, matrix = np.array([r["vec_id"] for r in rows], np.int64), _matrix([np.array(r["vector"], np.int64) for r in rows])
        # The first round: k-th scores from one shard, a row for each query.
        first = shards.limit(1).mapInPandas(_search(ids, matrix, k), _FOUND).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        least = {r["query_id"]: r["least"] for r in first.where(F.col("n") == k).collect()}
        known = np.array([least.get(i, NONE) for i in ids.tolist()], np.int64)
        part = shards.mapInPandas(_search(ids, matrix, k, known), _FOUND)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = found.withColumn("salt", F.spark_partition_id() % MERGE_SALTS)
    for group in (["query_id", "salt"], ["query_id"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id"))
        found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
