"""Sentiment labels, distributions and examples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import IntegerType

from reelgauge.functions import text as T
from reelgauge.functions.fixed import LABELS
from reelgauge.functions.values import percentage
from reelgauge.operators.embedding import HashedEmbedding, fit_embedding, sentence_embeddings  # noqa: F401
from reelgauge.operators.joins import join_lookup, kept
from reelgauge.operators.phrases import longest_matches

KEY, SEQ = "video_key", "arrival_seq"


def _label_of_score(score: Column) -> Column:
    return (
        F.when(score > 0, F.lit("positive"))
        .when(score < 0, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


class Lexicon:
    """Sign of the summed polarity of a comment's words; ``terms`` has ``term, polarity``.
    Equal entries count once, different polarities of one term add up, and entries without term or
    polarity are left out.

    Terms are split like the texts, into runs of letters. With terms of several words (``can't``,
    ``not bad``) the longest term counts where terms overlap, from left to right. A term without a
    letter can match nothing and is an error."""

    INLINE_TERMS = 20_000

    def __init__(self, terms: DataFrame):
        self.terms = terms.select(
            F.lower("term").alias("term"), F.col("polarity").cast("int").alias("polarity")
        ).where("term is not null and polarity is not null").distinct()

    def label(self, df: DataFrame, text: str) -> DataFrame:
        words = F.array_remove(T.words("term"), "")
        size = kept(self.terms.select(words.alias("words"), "polarity"))
        least, most = size.agg(F.min(F.size("words")), F.max(F.size("words"))).first()
        if least == 0:
            raise ValueError("a lexicon term has no letter")
        if most and most > 1:
            return self._phrases(df, size, text)
        head = self.terms.limit(self.INLINE_TERMS + 1).collect()
        if len(head) <= self.INLINE_TERMS:
            return df.withColumn("sentiment", _label_of_score(self._inline_score(head, text)))
        return self._joined(df, text)

    @staticmethod
    def _inline_score(head: list, text: str) -> Column:
        """The score inside the row: hash-set lookups, no join and no shuffle. Words outside the
        lexicon go first, so the sum runs over the hits only."""
        by_polarity: dict[int, set[str]] = {}
        for term, polarity in head:
            by_polarity.setdefault(polarity, set()).add(term)

        def add(total: Column, word: Column) -> Column:
            for polarity, terms in sorted(by_polarity.items()):
                hit = F.when(word.isin(sorted(terms)), F.lit(polarity)).otherwise(F.lit(0))
                total = total + hit
            return total

        known = sorted(set().union(*by_polarity.values()))
        hits = F.filter(T.words(text), lambda word: word.isin(known))
        return F.aggregate(hits, F.lit(0), add)

    @staticmethod
    def _phrases(df: DataFrame, terms: DataFrame, text: str) -> DataFrame:
        summed = terms.groupBy("words").agg(F.sum("polarity").cast("int").alias("value"))
        spoken = F.array_remove(T.words(F.coalesce(F.col(text), F.lit(""))), "")
        rows = df.withColumn("tokens", F.explode(F.array(spoken)))
        found = longest_matches(rows, summed, [KEY, SEQ])
        score = F.aggregate("matches", F.lit(0), lambda total, m: total + m["value"])
        return found.withColumn("sentiment", _label_of_score(score)).drop("tokens", "matches")

    def _joined(self, df: DataFrame, text: str) -> DataFrame:
        """For a lexicon too large for the row form; shuffles narrow rows only."""
        spoken = df.where(T.has_text(text)).select(KEY, SEQ, F.explode(T.words(text)).alias("term"))
        scores = (
            join_lookup(spoken, self.terms, "term")
            .groupBy(F.col(KEY).alias("_key"), F.col(SEQ).alias("_seq"))
            .agg(F.sum("polarity").alias("_score"))
        )
        same = F.col(KEY).eqNullSafe(F.col("_key")) & F.col(SEQ).eqNullSafe(F.col("_seq"))
        scored = df.join(scores, same, "left").drop("_key", "_seq")
        label = _label_of_score(F.coalesce(F.col("_score"), F.lit(0)))
        return scored.withColumn("sentiment", label).drop("_score")


class Trained:
    """A fitted pipeline whose prediction indexes ``labels``; confidence is its probability."""

    def __init__(
        self,
        model: PipelineModel,
        labels: Sequence[str] = LABELS,
        embedding: HashedEmbedding | None = None,
    ):
        self.model, self.labels, self.embedding = model, list(labels), embedding

    def label(self, df: DataFrame, text: str) -> DataFrame:
        names = F.array(*[F.lit(x) for x in self.labels])
        rows = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
        if self.embedding:
            rows = self.embedding.transform(rows, "_text", "_vector")
            rows = rows.withColumn("_features", array_to_vector("_vector"))
        scored = self.model.transform(rows)
        return scored.select(
            *df.columns,
            F.element_at(names, F.col("prediction").cast("int") + 1).alias("sentiment"),
            F.array_max(vector_to_array("probability")).alias("confidence"),
        )


class Hook:
    """A user model. ``load`` runs once per task and returns a function from a list of texts to
    a list of labels (None where the model has none)."""

    def __init__(self, load: Callable[[], Callable[[list[str]], list]], batch_size: int = 100):
        self.load, self.batch_size = load, batch_size

    def label(self, df: DataFrame, text: str) -> DataFrame:
        load, size = self.load, self.batch_size

        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for texts in batches:
                found: list = []
                for at in range(0, len(texts), size):
                    found.extend(model(texts.iloc[at : at + size].tolist()))
                yield pd.Series(found, dtype=object)

        run = F.pandas_udf(predict, "string")
        return df.withColumn("sentiment", run(F.coalesce(F.col(text), F.lit(""))))


class VectorHook:
    """A user model over a numeric vector column. ``load`` runs once per worker and returns a
    function from a matrix to label indexes."""

    def __init__(
        self,
        load: Callable[[], Callable],
        column: str,
        width: int,
        labels: Sequence[str] = LABELS,
        batch_size: int = 1000,
    ):
        self.load, self.column, self.width = load, column, width
        self.labels, self.batch_size = list(labels), batch_size

    def label(self, df: DataFrame, text: str) -> DataFrame:
        index = predict_batch_udf(
            self.load, return_type=IntegerType(), batch_size=self.batch_size,
            input_tensor_shapes=[[self.width]],
        )
        names = F.array(*[F.lit(x) for x in self.labels])
        return df.withColumn(
            "sentiment", F.try_element_at(names, index(F.col(self.column)) + 1)
        )


def label_sentiment(
    df: DataFrame, scorer: Lexicon | Trained | Hook | VectorHook, text: str = "text"
) -> DataFrame:
    """Add ``sentiment`` and ``confidence``; both NULL where the text is NULL or empty.

    A missing label becomes ``neutral``; confidence is 1.0 where the scorer has none.
    """
    labelled = scorer.label(df, text)
    usable = T.has_text(text)
    label = F.lower(F.coalesce(F.col("sentiment"), F.lit("neutral")))
    sure = F.col("confidence") if "confidence" in labelled.columns else F.lit(1.0)
    return labelled.withColumns(
        {"sentiment": F.when(usable, label), "confidence": F.when(usable, sure)}
    )


def sentiment_counts(labelled: DataFrame, key: str = KEY) -> DataFrame:
    """Comments, summed confidence and first arrival per video and label; the NULL label is
    unusable text."""
    return labelled.groupBy(key, "sentiment").agg(
        F.count("*").alias("count"),
        F.sum("confidence").alias("confidence"),
        F.min(SEQ).alias("first_seq"),
    )


def sentiment_totals(counts: DataFrame, key: str = KEY) -> DataFrame:
    """All and analysed comments per video; mean confidence is 0 where none is analysed."""
    analysed = F.sum(F.when(F.col("sentiment").isNotNull(), F.col("count")).otherwise(0))
    return (
        counts.groupBy(key)
        .agg(
            F.sum("count").alias("total_comments"),
            analysed.alias("total_analyzed"),
            F.sum("confidence").alias("_sure"),
        )
        .select(
            key,
            "total_comments",
            "total_analyzed",
            F.when(F.col("total_analyzed") > 0, F.col("_sure") / F.col("total_analyzed"))
            .otherwise(F.lit(0.0))
            .alias("average_confidence"),
        )
    )


def sentiment_distribution(counts: DataFrame, key: str = KEY) -> DataFrame:
    """One row per video and label, from ``sentiment_counts``. The totals are windows over the
    few label rows of each video."""
    video = Window.partitionBy(key)
    used = F.col("sentiment").isNotNull()
    analysed = F.sum(F.when(used, F.col("count")).otherwise(0)).over(video)
    return (
        counts.withColumns(
            {
                "total_comments": F.sum("count").over(video),
                "total_analyzed": analysed,
                "_sure": F.sum("confidence").over(video),
            }
        )
        .where(used)
        .select(
            key,
            "total_comments",
            "total_analyzed",
            "sentiment",
            "count",
            percentage(F.col("count"), F.col("total_analyzed")).alias("percentage"),
            (F.col("_sure") / F.col("total_analyzed")).alias("average_confidence"),
        )
    )


def sentiment_examples(
    labelled: DataFrame, counts: DataFrame | None = None, key: str = KEY, text: str = "text"
) -> DataFrame:
    """First text of each label per video, NULL where the label is absent.

    The counts hold the first arrival of each label; the texts are fetched by a join with that
    small table, so no text is sorted or shuffled to find the first.
    """
    counts = kept(sentiment_counts(labelled, key)) if counts is None else counts
    wanted = counts.where(F.col("sentiment").isNotNull()).select(
        key, F.col("first_seq").alias(SEQ), "sentiment"
    )
    texts = join_lookup(labelled.select(key, SEQ, text), wanted, [key, SEQ])
    found = texts.groupBy(key).agg(
        *[F.max(F.when(F.col("sentiment") == x, F.col(text))).alias(x) for x in LABELS]
    )
    return counts.select(key).distinct().join(found, key, "left")


def dominant_sentiment(counts: DataFrame, key: str = KEY) -> DataFrame:
    """The most frequent label per video; ties go by label name."""
    best = F.row_number().over(
        Window.partitionBy(key).orderBy(F.desc("count"), F.asc("sentiment"))
    )
    labels = counts.where(F.col("sentiment").isNotNull())
    return labels.withColumn("_r", best).where(F.col("_r") == 1).select(key, "sentiment", "count")


def _word_stages() -> list:
    return [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[^\p{L}]+"),
        StopWordsRemover(inputCol="_words", outputCol="_kept"),
    ]


def train_sentiment(
    examples: DataFrame,
    text: str = "text",
    label: str = "sentiment",
    labels: Sequence[str] = LABELS,
    features: int = 1 << 16,
    embedding_size: int = 0,
    seed: int = 7,
) -> Trained:
    """Fit class-weighted logistic regression on hashed TF-IDF terms, or on mean word vectors
    where ``embedding_size`` is set."""
    names = F.array(*[F.lit(x) for x in labels])
    rows = examples.select(
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        (F.array_position(names, F.col(label)) - 1).cast("double").alias("_label"),
    ).where(F.col("_label") >= 0)
    sizes = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    total = sum(sizes.values())
    weight = F.lit(1.0)
    for value, n in sizes.items():
        weight = F.when(F.col("_label") == value, total / (len(sizes) * n)).otherwise(weight)
    rows = rows.withColumn("_weight", weight)
    classifier = LogisticRegression(
        featuresCol="_features", labelCol="_label", weightCol="_weight", maxIter=25,
        regParam=0.01, family="multinomial",
    )
    if embedding_size:
        embedding = fit_embedding(rows, "_text", embedding_size, seed=seed)
        vectors = embedding.transform(rows, "_text", "_vector").withColumn("_features", array_to_vector("_vector"))
        return Trained(Pipeline(stages=[classifier]).fit(vectors), labels, embedding)
    terms = [
        HashingTF(inputCol="_kept", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_features", minDocFreq=2),
    ]
    return Trained(Pipeline(stages=[*_word_stages(), *terms, classifier]).fit(rows), labels)
