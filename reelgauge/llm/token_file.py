"""Token files: frequency-ranked ids in a byte-aligned variable-length code.

The most frequent id gets rank 0. A rank takes one to four bytes; two bits of a separate control
byte tell how many, so that one control byte serves four ids and a table of 256 rows decodes it.

A folder holds ``blocks`` (Parquet rows: shard, first, doc_ids, counts, control, data; ``first`` counts
the shard's ids before the block), in ascending doc_id order over shard, first and position, and ``ranks`` (the id of each rank). Parquet is the
container because every store that Spark reaches can hold it and a lost task leaves no half file.

Defined cases: a null or empty text has the end id only; null doc_ids come first; rows that repeat a
doc_id lie next to each other, ordered by their ids; an empty table gives a folder without blocks.
Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, chunk_encoder, saved, shared_folder

#: Bytes of text that are encoded at once; more of it means fewer distinct words to look up.
ENCODE_BYTES = 8 << 20
#: Ids after which a block of a token file ends.
BLOCK_IDS = 1 << 19

#: For each control byte the lengths of its four ranks, and where each begins in their bytes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
#: Which bytes of a little-endian number stay, by its length less one: four flags held as one number.
_BYTES = (np.arange(4) <= np.arange(4)[:, None]).view("<u4").reshape(-1)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = values.astype("<u4")
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    for bound in (0xFF, 0xFFFF, 0xFFFFFF):
        codes[:len(values)] += values > bound
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    return control.tobytes(), values.view(np.uint8)[_BYTES[codes[:len(values)]].view(bool)].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers of ``pack``, by look-up in the table of control bytes."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(lengths)
    held = np.frombuffer(data + b"\0\0\0", np.uint8)
    if not count:
        return np.zeros(0, np.uint32)
    words = np.lib.stride_tricks.as_strided(held, (len(data), 4), (1, 1))[ends - lengths]
    return np.ascontiguousarray(words).view("<u4").reshape(-1) & _KEEP[lengths]


def encoded_texts(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """doc_id, n_tokens, ids: the library's ids of each whole text and the end id, as compressed
    little-endian numbers of 32 bits."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer_path)
        for block in blocks(batches, ENCODE_BYTES):
            ids, counts = encoder.encode(block.column("text"))
            found, at = [], 0
            for n in counts.tolist():
                found.append(squeeze(np.append(ids[at:at + n], np.uint32(end_id))))
                at += n
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(counts + 1), pa.array(found, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(per_batch, "doc_id long, n_tokens long, ids binary")


def squeeze(ids: np.ndarray) -> bytes:
    """Compressed ids, of 16 bits where these do: the width, the number of bytes, zstd of level 1."""
    width = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
    plain = ids.astype(width)
    return width[2].encode() + plain.nbytes.to_bytes(8, "little") + _zstd().compress(plain, asbytes=True)


def expand(held: bytes) -> np.ndarray:
    plain = _zstd().decompress(memoryview(held)[9:], int.from_bytes(held[1:9], "little"))
    return np.frombuffer(plain, f"<u{held[:1].decode()}").astype(np.uint32)


@cache
def _zstd() -> pa.Codec:
    return pa.Codec("zstd", 1)


def id_counts(encoded: DataFrame) -> DataFrame:
    """id, n: how often each id occurs in all documents."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                more = np.bincount(np.concatenate([expand(x) for x in batch.column("ids").to_pylist()]))
                size = max(len(total), len(more))
                total = np.pad(total, (0, size - len(total))) + np.pad(more, (0, size - len(more)))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    return encoded.select("ids").mapInArrow(per_batch, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1) -> None:
    """Write the ids of all texts to ``folder``. The ids are stored once before they are ranked,
    so that no text is encoded twice. The driver sees one row for each id of the vocabulary."""
    spark = docs.sparkSession
    encoded = saved(encoded_texts(docs, tokenizer_path, end_id), "encoded-texts")
    by_rank = np.array([r[0] for r in id_counts(encoded).orderBy(F.desc("n"), "id").select("id").collect()], np.uint32)
    rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank))

    def per_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            control, data = pack(rank[np.concatenate(held)])
            columns = [pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([list(map(len, held))], pa.list_(pa.int64())), pa.array([control], pa.binary()), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "first", "doc_ids", "counts", "control", "data"])

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                doc_ids.append(doc_id)
                held.append(expand(ids))
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield block()
                    doc_ids, held, first, size = [], [], first + size, 0
        if held:
            yield block()

    (
        encoded.withColumn("tie", F.xxhash64("ids"))  # boundaries are sampled keys, and should be small
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "ids")
        .select("doc_id", "ids")
        .mapInArrow(per_shard, "shard int, first long, doc_ids array<long>, counts array<long>, control binary, data binary")
        .write.option("compression", "zstd")
        .parquet(f"{folder}/blocks")
    )
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit
    numbers). Only the shards' totals and the ranks pass the driver."""
    by_rank = np.array([r[0] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").select("id").collect()], np.uint32)
    stored = spark.read.parquet(f"{folder}/blocks")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    shards = stored.groupBy("shard").agg(F.sum(total).alias("n")).orderBy("shard").collect()
    before = dict(zip([r["shard"] for r in shards], np.cumsum([0, *(r["n"] for r in shards)])[:-1].tolist(), strict=True))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                ids = by_rank[unpack(row["control"], row["data"], int(ends[-1]))].astype("<u4")
                parts = [x.tobytes() for x in np.split(ids, ends[:-1])]
                start = before[row["shard"]] + row["first"] + ends - counts
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(counts), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    return stored.mapInArrow(per_batch, "doc_id long, start long, n_tokens long, ids binary")


def through_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write the token files of the documents to the shared folder and read them back."""
    folder = f"{shared_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, folder, tokenizer_path, end_id)
    return read_token_files(docs.sparkSession, folder)
