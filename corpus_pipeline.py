"""The corpus pipeline: quality rules, language ID, near-duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelgauge.llm import stages

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", stages.quality_rules),
    ("language_id", stages.language_id),
    ("near_duplicates", stages.near_duplicates),
    ("mixing", stages.mix),
    ("packing", stages.pack),
]

#: SQL can express neither the forest nor the language model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows lie in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stages.stored(docs, name)
    return docs
