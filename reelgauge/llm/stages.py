"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir); all but ``pack`` return rows
with the columns of ``docs``.

Models are fitted on the stage's own input. Verdicts are taken inside the rows, so that rows without
doc_id or with a repeated one are judged on their own and no text is shuffled for a filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.operators.joins import join_lookup

from . import language, mixing, near_dup, packing, quality
from .common import BLOCK_BYTES, blocks, saved, texts_of

stored = saved


def _where(docs: DataFrame, keeps: Callable[[list[bytes]], np.ndarray], limit: int = BLOCK_BYTES) -> DataFrame:
    """The rows whose texts ``keeps`` accepts, all columns as they are."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit):
            yield block.filter(pa.array(keeps(texts_of(block))))

    return docs.mapInArrow(per_batch, docs.schema)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose rule statistics are no anomaly. Texts are read
    once; their counts lie beside them in a table.

    Rows with null or empty text go, as have too few words; rows without doc_id or with a repeated
    one are judged one by one; without labels of both kinds only the base rules reject; an empty
    table stays empty."""
    rows = saved(quality.with_statistics(docs), "rule-statistics")
    statistics = quality.statistics_in(rows)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    forest = quality.fit_forest(statistics, labels)
    threshold = quality.calibrate(quality.with_score(statistics, forest), labels)
    return quality.passing(rows, forest, threshold)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language. Texts in others, random letters and texts without a letter go;
    the loss among those learned from is ``language.KNOWN_LOSS``, whatever the number of languages.

    Null and empty texts go; rows without lang or doc_id are not learned from but judged; where no
    row can be learned from, none stays; repeated rows are judged one by one."""
    return _where(docs, language.fit(docs).known, language.GRAM_BYTES)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group, and those in no group."""
    judged = saved(near_dup.near_duplicates(docs).select("doc_id", "kept"), "near-duplicates")
    gone = judged.where("not kept").select("doc_id").distinct()
    kept = join_lookup(docs, gone, "doc_id", "left_anti")
    # Rows that repeat a doc_id are one document; only these are compared as rows.
    repeated = saved(judged.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if repeated.limit(1).count() == 0:
        return kept
    first = join_lookup(kept, repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return join_lookup(kept, repeated, "doc_id", "left_anti").unionByName(first)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them. A null source is one of its own; texts
    without a word and rows of a source of size 0 go; repeated rows count one by one."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences, with the checksum of their ids. A null text is
    empty and one end id long; rows with a repeated or null doc_id are pieces of their own."""
    rows = packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
