"""Clean token arrays and vocabularies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.functions import text as T
from reelgauge.functions.fixed import MIN_DOCUMENTS, STOP_WORDS, VOCABULARY_SIZE


def with_tokens(
    df: DataFrame,
    text: str = "text",
    stop_words: Sequence[str] = STOP_WORDS,
    lower: bool = False,
    name: str = "tokens",
) -> DataFrame:
    """Add the clean token array; rows without any token are dropped.

    A filter on a plain column would be pushed below it and clean each text twice; it is not
    pushed below a generator, hence the explode of a one-element array.
    """
    tokens = F.explode(F.array(T.clean_tokens(text, stop_words, lower)))
    return df.select("*", tokens.alias(name)).where(F.size(name) > 0)


def term_counts(df: DataFrame, key: str | None = None, tokens: str = "tokens") -> DataFrame:
    """Occurrences and document count of each term, per ``key`` if given.

    Every row emits its tokens, and its distinct tokens once more for the document count, so
    one aggregate with map-side partial sums gives both.
    """
    group = [key] if key else []
    both = F.array(F.col(tokens), F.array_distinct(tokens))
    listed = df.select(*group, F.posexplode(both).alias("once", "terms"))
    return (
        listed.select(*group, "once", F.explode("terms").alias("term"))
        .groupBy(*group, "term")
        .agg(
            F.count_if(F.col("once") == 0).alias("frequency"),
            F.count_if(F.col("once") == 1).alias("documents"),
        )
    )


def vocabulary(
    df: DataFrame,
    key: str | None = None,
    tokens: str = "tokens",
    size: int = VOCABULARY_SIZE,
    min_documents: float = MIN_DOCUMENTS,
) -> DataFrame:
    """The ``size`` most frequent terms found in at least ``min_documents`` rows, ranked from 1.

    Equal frequencies go by term, which makes the vocabulary repeatable.
    """
    usable = term_counts(df, key, tokens).where(F.col("documents") >= min_documents)
    order = [F.desc("frequency"), F.asc("term")]
    if key:
        ranked = usable.withColumn(
            "rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))
        )
        return ranked.where(F.col("rank") <= size)
    top = usable.orderBy(*order).limit(size)
    # Only the limited rows reach this single partition.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def vocabulary_size(vocab: DataFrame, key: str | None = None) -> DataFrame:
    return vocab.groupBy(*([key] if key else [])).agg(F.count("*").alias("vocabulary_size"))


def skipped_videos(
    comments: DataFrame, rows: DataFrame, vocab: DataFrame, key: str = "video_key"
) -> DataFrame:
    """Videos that get no topic model and why; ``rows`` are the comments with tokens and
    ``vocab`` their vocabulary by video."""
    left = comments.select(key).distinct()
    left = left.join(vocab.select(key).distinct(), key, "left_anti")
    with_tokens = rows.groupBy(key).agg(F.count("*").alias("_n"))
    reason = F.when(F.col("_n").isNull(), "no tokens").otherwise("no frequent term")
    return left.join(with_tokens, key, "left").select(key, reason.alias("reason"))
