"""Text blocks inside tasks, tables in the shared folder, and tokenizer look-ups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.session import give_back

#: Bytes of text that a task handles at once; one longer text makes a block of its own.
BLOCK_BYTES = 4 << 20

#: A word, as all contracts of this package define it.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or one in the warehouse where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def write_table(df: DataFrame, label: str) -> str:
    """Write the rows once below the shared folder; the path."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to a table in the shared folder and read them from there.

    It cuts the lineage; lost executors cost no more than the tasks they ran.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, label))


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unsigned(code: int) -> int:
    return code & 0xFFFFFFFF


def smallest(rows: DataFrame, code: Column, n: int, by: list[str]) -> DataFrame:
    """The ``n`` rows with the smallest codes (uniform longs), ties by the columns ``by``; of those
    below a bound of the code, set by the number of rows, so that tasks do not send ``n`` each."""
    total = rows.count()
    share = (n + 8 * n**0.5) / max(total, 1)
    while share < 1:
        some = rows.where(code <= int(share * (1 << 64)) - (1 << 63))
        if some.count() >= n:
            return some.orderBy(code, *by).limit(n)
        share *= 2
    return rows.orderBy(code, *by).limit(n)


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow rows, cut so that a block's texts stay below ``limit`` bytes together, or hold one
    text. Blocks are copies: Arrow's ascii_lower goes wrong on slices that begin inside an array."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        first, total = 0, 0
        for i, size in enumerate(sizes):
            if i > first and total + size > limit:
                yield batch.take(pa.array(np.arange(first, i)))
                first, total = i, 0
            total += size
        if first < len(sizes):
            yield batch.take(pa.array(np.arange(first, len(sizes)))) if first else batch
    give_back()


def texts_of(block: pa.RecordBatch) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return [x or b"" for x in block.column("text").cast(pa.binary()).to_pylist()]


def flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts end to end, and where each text starts, with the end of the last."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=starts[1:])
    return np.frombuffer(b"".join(texts), np.uint8), starts


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of the values of each span."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


@cache
def tokenizer(path: str):
    """The library's tokenizer, loaded once in a worker; a worker is one thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ChunkEncoder:
    """Ids of whole texts by a tokenizer that lower-cases, drops white space and ends every word
    with a token of its own, such as ``word_bpe_49k.json``.

    No token of such a tokenizer crosses white space, so the ids of a text are those of its chunks
    in order. Each distinct chunk goes to the library once and is then looked up. A table above
    ``limit`` chunks keeps those met again after the call that brought them, and none where these are more than three
    quarters of the limit, which bounds memory and changes no result.

    Fewer chunks differ once Latin-1 texts are lower-cased and punctuation after a letter at a
    chunk's end is set apart, neither of which changes the library's ids.
    """

    def __init__(self, path: str, limit: int = 400_000):
        self.library = tokenizer(path)
        self.limit = limit
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.at, self.length = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)
        self.again = np.zeros(1 << 18, bool)

    def trim(self) -> None:
        names, rows = list(self.known), np.flatnonzero(self.again[:len(self.known)])
        if len(rows) > self.limit * 3 // 4:
            rows = rows[:0]
        lengths = self.length[rows]
        ends = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.at[rows] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))]
        self.reset()
        self.add([names[i] for i in rows.tolist()], lengths, ids)

    def whole(self, chunk: str) -> np.ndarray:
        return np.array(self.library.encode(chunk, add_special_tokens=False).ids, np.uint32)

    def learn(self, chunks: list[str]) -> None:
        """Look-up rows for chunks that are new. Chunks of letters only are one word each, so
        that one call does for all of them."""
        words = [x for x in chunks if x.isalpha()]
        others = [x for x in chunks if not x.isalpha()]
        found: list[np.ndarray] = []
        if words:
            # Without offsets, which nobody reads and which cost a third of the time.
            ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(words) and ends[-1] == len(ids):
                lengths, blocks_ = np.diff(ends, prepend=0), [ids]
            else:  # a letter whose lower case is more than letters
                others, words, lengths, blocks_ = words + others, [], np.zeros(0, np.int64), []
        else:
            lengths, blocks_ = np.zeros(0, np.int64), []
        found = [self.whole(x) for x in others]
        lengths = np.concatenate([lengths, np.fromiter(map(len, found), np.int64, len(found))])
        self.add(words + others, lengths, np.concatenate([*blocks_, *found]))

    def add(self, chunks: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        first, count = len(self.known), len(lengths)
        self.known.update(zip(chunks, range(first, first + count), strict=True))
        while first + count > len(self.at):
            self.at, self.length, self.again = (np.resize(x, 2 * len(x)) for x in (self.at, self.length, self.again))
        self.again[first:first + count] = False
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.at[first:first + count] = self.used + np.cumsum(lengths) - lengths
        self.length[first:first + count] = lengths
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) end to end, and the number of ids of each."""
        if len(self.known) > self.limit:
            self.trim()
        before = len(self.known)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        plain = pc.invert(pc.match_substring_regex(texts, r"[^\x{00}-\x{FF}]|<\|"))
        apart = pc.replace_substring_regex(pc.utf8_lower(texts), r"([\pL0-9])([.,!?;:]+)(\s|$)", r"\1 \2\3")
        split = pc.ascii_split_whitespace(pc.if_else(plain, apart, texts))
        counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # an eighth of to_pylist's time
        rows = list(map(self.known.get, names))
        if None in rows:
            self.learn([c for c, r in zip(names, rows, strict=True) if r is None])
            rows = list(map(self.known.__getitem__, names))
        rows = np.array(rows, np.int64)
        self.again[rows[rows < before]] = True
        rows = rows[coded.indices.to_numpy()]
        lengths = self.length[rows]
        ends = np.cumsum(lengths)
        # A block has fewer than 2^31 ids, as a string has fewer bytes.
        take = np.repeat((self.at[rows] - (ends - lengths)).astype(np.int32), lengths)
        take += np.arange(len(take), dtype=np.int32)
        starts = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=starts[1:])
        return self.ids[take], sums(lengths, starts)


@cache
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder in a worker, with what it has looked up for earlier tasks."""
    return ChunkEncoder(path)


def upper_limit(values: np.ndarray, counts: np.ndarray, loss: float) -> float:
    """The value that a share ``loss`` of the counted ones exceeds. Fewer than 1 / loss of them cannot
    show it; their largest is then moved up by an exponential tail through it and their median."""
    order = np.argsort(values, kind="stable")
    values, below = np.asarray(values, float)[order], np.cumsum(np.asarray(counts)[order])
    n = int(below[-1])
    top = values[np.searchsorted(below, n - int(n * loss))]
    middle = values[np.searchsorted(below, n / 2)]
    return float(top + (top - middle) * max(-np.log(loss * n), 0.0) / np.log(max(n / 2, 2)))
