"""Comment vectors by signed feature hashing, with memory that does not depend on the vocabulary.

Every word falls into one of a fixed number of buckets. A bucket's vector is the sum, over all words
beside its words, of random signs that belong to their buckets: a randomized projection of the
co-occurrence counts. The sums are integers, so that they do not depend on the order of the tasks.
A comment's vector is the mean of its words' vectors, the frequent buckets weighing less.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions import text as T
from reelgauge.functions.fixed import STOP_WORDS
from reelgauge.operators.phrases import list_blocks
from reelgauge.session import give_back

BUCKETS, WINDOW = 1 << 14, 4
#: A bucket with this share of all words weighs one half.
HALF = 1e-3
#: Words whose vectors a task holds at once.
BLOCK_WORDS = 1 << 16


def word_buckets(value: Column | str, buckets: int = BUCKETS, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Buckets of the words of a text without stop words; of an empty list for NULL."""
    stop = [w.lower() for w in stop_words]
    column = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(""))
    words = F.filter(T.words(column), lambda w: (w != "") & ~w.isin(stop))
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


def _signs(buckets: int, size: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2, (buckets, size), np.int8) * 2 - 1


def _sums(buckets: int, size: int, window: int, seed: int):
    """For each bucket that a task meets: its words, and the summed signs of the words beside."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = _signs(buckets, size, seed)
        total, count = np.zeros((buckets, size), np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            lists = batch.column("words")
            words = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
            count += np.bincount(words, minlength=buckets)
            for apart in range(1, window + 1):
                for low in range(0, len(words) - apart, BLOCK_WORDS):
                    high = min(low + BLOCK_WORDS, len(words) - apart)
                    same = row[low + apart:high + apart] == row[low:high]
                    one, two = words[low:high][same], words[low + apart:high + apart][same]
                    for here, beside in ((one, two), (two, one)):
                        order = np.argsort(here, kind="stable")
                        cut = np.flatnonzero(np.diff(here[order], prepend=-1))
                        if len(cut):
                            total[here[order][cut]] += np.add.reduceat(signs[beside[order]], cut, dtype=np.int64)
        met = np.flatnonzero(count)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(met) + 1, dtype=np.int32) * size), pa.array(total[met].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(count[met]), sums], names=["bucket", "n", "sums"])
        give_back()

    return per_task


class HashedEmbedding:
    """Fixed tables: a vector for each bucket, already weighted."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors

    def transform(self, df: DataFrame, text: str, name: str = "embedding") -> DataFrame:
        """Add the mean vector of the words, zero where there is none."""
        sent = df.sparkSession.sparkContext.broadcast(self.vectors)
        buckets, size = self.vectors.shape

        def mean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                for (lists,) in list_blocks([batch], 0, BLOCK_WORDS):
                    counts = np.diff(lists.offsets.to_numpy())
                    words = lists.flatten().to_numpy(zero_copy_only=False)
                    out = np.zeros((len(counts), size))
                    filled = np.flatnonzero(counts)
                    if len(words) > BLOCK_WORDS:  # one long text
                        for low in range(0, len(words), BLOCK_WORDS):
                            out[0] += sent.value[words[low:low + BLOCK_WORDS]].sum(0)
                        out /= len(words)
                    elif len(filled):
                        starts = (np.cumsum(counts) - counts)[filled]
                        out[filled] = np.add.reduceat(sent.value[words], starts) / counts[filled, None]
                    offsets = pa.array(np.arange(len(counts) + 1, dtype=np.int32) * size)
                    yield pa.ListArray.from_arrays(offsets, pa.array(out.astype(np.float32).ravel()))
            give_back()

        return df.withColumn(name, F.arrow_udf(mean, "array<float>")(word_buckets(text, buckets)))


def fit_embedding(
    df: DataFrame, text: str = "text", size: int = 32, buckets: int = BUCKETS, window: int = WINDOW, seed: int = 7
) -> HashedEmbedding:
    """Sum the statistics of all comments and turn them into vectors of length one, weighted by
    rarity. A task, the shuffle of a task and the driver hold at most buckets x size numbers."""
    words = df.select(F.explode(F.array(word_buckets(text, buckets))).alias("words"))
    parts = words.mapInArrow(_sums(buckets, size, window, seed), "bucket int, n long, sums array<long>")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(size)]).alias("sums")).collect()
    vectors, count = np.zeros((buckets, size)), np.zeros(buckets)
    for row in rows:
        vectors[row["bucket"]], count[row["bucket"]] = row["sums"], row["n"]
    share = count / max(count.sum(), 1)
    signs = _signs(buckets, size, seed)
    # What a bucket would sum to beside words of the corpus at random says nothing about it.
    vectors -= count[:, None] * 2 * window * (share @ signs)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
    return HashedEmbedding(vectors * (HALF / (HALF + share))[:, None])


def sentence_embeddings(
    df: DataFrame, text: str = "text", size: int = 32, seed: int = 7
) -> DataFrame:
    """Vector of each comment, fitted on the comments themselves."""
    return fit_embedding(df, text, size, seed=seed).transform(df, text)
