"""The three per-video reports as nested rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.fixed import TOP_ENTITIES
from reelgauge.operators import entities as E
from reelgauge.operators import sentiment as S
from reelgauge.operators.joins import kept

KEY = "video_key"


def sentiment_report(
    comments: DataFrame, scorer: S.Lexicon | S.Trained | S.Hook, text: str = "text"
) -> DataFrame:
    """Totals, label distribution and examples per video. Comments are labelled once."""
    labelled = S.label_sentiment(comments, scorer, text)
    counts = kept(S.sentiment_counts(labelled))
    entry = F.struct(
        F.col("sentiment"), F.struct("count", "percentage").alias("share")
    )
    shares = S.sentiment_distribution(counts).groupBy(KEY).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("_shares")
    )
    none = F.expr("map_from_arrays(array(), array())")
    return (
        S.sentiment_totals(counts)
        .join(shares, KEY, "left")
        .join(S.sentiment_examples(labelled, counts, text=text), KEY, "left")
        .select(
            KEY,
            "total_comments",
            F.struct(
                "total_analyzed",
                F.coalesce("_shares", none.cast(shares.schema["_shares"].dataType)).alias(
                    "sentiment_distribution"
                ),
                "average_confidence",
            ).alias("sentiment_stats"),
            F.struct(*S.LABELS).alias("sentiment_examples"),
        )
    )


def entity_report(
    comments: DataFrame,
    tagger: E.Gazetteer | E.Patterns | E.Hook,
    n: int = TOP_ENTITIES,
    text: str = "text",
) -> DataFrame:
    """Totals, top entities and the same entities by type per video."""
    counts = kept(E.entity_counts(E.tag_entities(comments, tagger, text)))
    top = kept(E.top_entities(counts, n))
    ranked = top.groupBy(KEY).agg(
        F.array_sort(F.collect_list(F.struct("rank", "text", "type", "count"))).alias("_top")
    )
    listed = F.transform("_top", lambda e: F.struct(e["text"], e["type"], e["count"]))
    by_type = E.entities_by_type(top)
    empty_list = F.array().cast("array<struct<text:string,type:string,count:bigint>>")
    empty_map = F.expr("map_from_arrays(array(), array())").cast(
        by_type.schema["entities_by_type"].dataType
    )
    return (
        E.entity_totals(comments, counts)
        .join(ranked, KEY, "left")
        .join(by_type, KEY, "left")
        .select(
            KEY,
            "total_comments",
            "processed_comments",
            "total_entities",
            F.coalesce(listed, empty_list).alias("top_entities"),
            F.coalesce("entities_by_type", empty_map).alias("entities_by_type"),
        )
    )


def topic_report(comments: DataFrame, topics: DataFrame, metrics: DataFrame) -> DataFrame:
    """Topics, vocabulary size and model metrics of the videos that have a model."""
    totals = comments.groupBy(KEY).agg(F.count("*").alias("total_comments"))
    listed = topics.groupBy(KEY).agg(
        F.array_sort(F.collect_list(F.struct(F.col("topic").alias("topic_id"), "words"))).alias(
            "topics"
        )
    )
    return (
        listed.join(metrics, KEY)
        .join(totals, KEY)
        .select(
            KEY,
            "total_comments",
            "topics",
            "vocabulary_size",
            F.struct("log_likelihood", "log_perplexity", "steps").alias("model_metrics"),
        )
    )
