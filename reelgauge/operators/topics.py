"""LDA topics over all comments, by MLlib."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.fixed import (
    LEARNING_DECAY,
    LEARNING_OFFSET,
    MIN_DOCUMENTS,
    NUM_TOPICS,
    SUBSAMPLING_RATE,
    TERMS_PER_TOPIC,
    TOPIC_ITERATIONS,
    VOCABULARY_SIZE,
)
from reelgauge.operators.joins import kept
from reelgauge.operators.tokens import vocabulary


@dataclass
class TopicModel:
    lda: LDAModel
    words: list[str]
    vectors: DataFrame

    def release(self) -> None:
        """Drop the cached vectors once the results are written."""
        self.vectors.unpersist()


def fit_topics(
    rows: DataFrame,
    tokens: str = "tokens",
    k: int = NUM_TOPICS,
    max_iter: int = TOPIC_ITERATIONS,
    vocab_size: int = VOCABULARY_SIZE,
    min_df: float = MIN_DOCUMENTS,
    seed: int = 7,
) -> TopicModel:
    """One online LDA over rows with clean tokens.

    The vocabulary is ranked with fixed ties and the seed is explicit, so a fit repeats. At most
    ``vocab_size`` words reach the driver. Raises where no term is frequent enough.
    """
    vocab = vocabulary(rows, None, tokens, vocab_size, min_df).orderBy("rank").select("term")
    words = [r["term"] for r in vocab.collect()]
    if not words:
        raise ValueError(f"no term occurs in {min_df} rows")
    counter = CountVectorizerModel.from_vocabulary(words, inputCol=tokens, outputCol="features")
    vectors = kept(counter.transform(rows).drop(tokens))
    lda = LDA(
        k=k, maxIter=max_iter, optimizer="online", learningOffset=LEARNING_OFFSET,
        learningDecay=LEARNING_DECAY, subsamplingRate=SUBSAMPLING_RATE,
        optimizeDocConcentration=True, seed=seed,
    )
    return TopicModel(lda.fit(vectors), words, vectors)


def topic_words(model: TopicModel, terms: int = TERMS_PER_TOPIC) -> DataFrame:
    """``topic, words, weights`` with the heaviest terms of each topic."""
    vocab = F.array(*[F.lit(w) for w in model.words])
    return model.lda.describeTopics(terms).select(
        "topic",
        F.transform("termIndices", lambda i: F.element_at(vocab, i + 1)).alias("words"),
        F.col("termWeights").alias("weights"),
    )


def topic_metrics(model: TopicModel) -> DataFrame:
    spark = model.vectors.sparkSession
    row = (
        len(model.words),
        float(model.lda.logLikelihood(model.vectors)),
        float(model.lda.logPerplexity(model.vectors)),
    )
    return spark.createDataFrame(
        [row], "vocabulary_size bigint, log_likelihood double, log_perplexity double"
    )


def topic_mixture(model: TopicModel, key: str = "video_key") -> DataFrame:
    """Mean topic weights of each video's comments under the shared model, over the comments
    that have a term of the vocabulary.

    As in ``with_tokens``, the explode of a one-element array keeps the filters above the
    inference, which would otherwise be pushed below it and run it once for each of them.
    """
    mixture = F.explode(F.array(vector_to_array("topicDistribution")))
    weights = model.lda.transform(model.vectors).select(key, mixture.alias("_weights"))
    return (
        weights.where(F.exists("_weights", lambda w: w > 0))
        .select(key, F.posexplode("_weights").alias("topic", "weight"))
        .groupBy(key, "topic")
        .agg(F.avg("weight").alias("weight"), F.count("*").alias("comments"))
    )


def topic_summary(topics: DataFrame, words: int = 5) -> DataFrame:
    """Leading words of each topic as one text."""
    return topics.withColumn("summary", F.array_join(F.slice("words", 1, words), ", "))
