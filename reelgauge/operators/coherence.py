"""Coherence of topics: normalized pointwise mutual information of their words in the comments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.operators.joins import join_lookup, kept

KEY = "video_key"


def topic_coherence(
    rows: DataFrame, topics: DataFrame, key: str = KEY, tokens: str = "tokens", terms: int = 10
) -> DataFrame:
    """video, topic, coherence, pairs: the mean NPMI of the pairs among a topic's first ``terms`` words.

    ``rows`` are comments with a token array, ``topics`` have ``words`` by video and topic. A pair
    that no comment holds together counts -1, one that all hold 1. Each comment is cut to the
    words of its video's topics inside the row; only counts of words and pairs are shuffled. A
    topic of fewer than two words has no pairs and no coherence.
    """
    cut = topics.select(key, "topic", F.array_distinct(F.slice("words", 1, terms)).alias("words"))
    wanted = kept(cut.groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list("words"))).alias("_wanted")))
    met = join_lookup(rows.select(key, tokens), wanted, key)
    held = met.select(key, F.explode(F.array(F.array_sort(F.array_intersect(F.array_distinct(tokens), "_wanted")))).alias("w"))
    alone = F.transform("w", lambda x: F.struct(x.alias("a"), x.alias("b")))
    pairs = F.expr("flatten(transform(w, (x, i) -> transform(slice(w, i + 2, size(w)), y -> named_struct('a', x, 'b', y))))")
    none = F.array(F.struct(F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b")))  # counts the comment
    counted = kept(
        held.select(key, F.inline(F.concat(none, alone, pairs))).groupBy(key, "a", "b").agg(F.count("*").alias("n"))
    )
    total = counted.where("a is null").select(key, F.col("n").alias("_all"))
    single = counted.where("a = b").select(key, F.col("a").alias("_word"), F.col("n").alias("_n"))
    double = counted.where("a < b").select(key, "a", "b", F.col("n").alias("_both"))
    asked = cut.select(key, "topic", F.explode(F.array(F.array_sort("words"))).alias("w"))
    asked = asked.select(key, "topic", F.inline(pairs)).join(total, key)
    for side in ("a", "b"):
        mine = single.select(F.col(key).alias("_k"), "_word", F.col("_n").alias(f"_{side}"))
        asked = asked.join(mine, (F.col(key) == F.col("_k")) & (F.col(side) == F.col("_word")), "left").drop("_k", "_word")
    together = double.select(F.col(key).alias("_k"), F.col("a").alias("_x"), F.col("b").alias("_y"), "_both")
    asked = asked.join(together, (F.col(key) == F.col("_k")) & (F.col("a") == F.col("_x")) & (F.col("b") == F.col("_y")), "left")
    both = F.col("_both") / F.col("_all")
    npmi = (
        F.when(F.col("_both").isNull(), -1.0)
        .when(F.col("_both") == F.col("_all"), 1.0)
        .otherwise(F.ln(F.col("_both") * F.col("_all") / (F.col("_a") * F.col("_b"))) / -F.ln(both))
    )
    return asked.groupBy(key, "topic").agg(F.avg(npmi).alias("coherence"), F.count("*").alias("pairs"))
