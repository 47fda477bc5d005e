"""One LDA per video, all videos fitted together.

Online variational Bayes (Hoffman, Blei and Bach, 2010) with one model row per video. Each
iteration is one Spark job over a sample of every video's comments, at least one of each: comments
are joined to their video's model, tasks sum their sufficient statistics before the shuffle, and the sums update the
models. The number of jobs does not grow with the number of videos, and a large video's comments
stay spread over the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
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
from reelgauge.operators.joins import join_lookup, measured_bytes
from reelgauge.operators.tokens import skipped_videos, vocabulary
from reelgauge.session import scratch_dir, stored

KEY, SEQ = "video_key", "arrival_seq"


def _helpers():
    """Numeric helpers, made inside a function so that they travel with the tasks."""

    def digamma(x):
        total = np.zeros_like(x)
        for _ in range(6):
            total, x = total - 1.0 / x, x + 1.0
        r = 1.0 / (x * x)
        series = r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))
        return total + np.log(x) - 0.5 / x - series

    def trigamma(x):
        total = np.zeros_like(x)
        for _ in range(6):
            total, x = total + 1.0 / (x * x), x + 1.0
        r = 1.0 / (x * x)
        series = r * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))
        return total + 1.0 / x + 0.5 * r + series / x

    def lgamma(x):
        shift = np.zeros_like(x)
        for _ in range(8):
            shift, x = shift + np.log(x), x + 1.0
        r = 1.0 / (x * x)
        series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / x
        return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - shift

    def fit_documents(counts, beta, alpha):
        """Topic weights of documents padded to one length: counts (b, n), beta (b, n, k)."""
        gamma = np.ones((len(counts), alpha.shape[1]))
        live = np.arange(len(counts))
        while len(live):
            g = gamma[live]
            theta = np.exp(digamma(g) - digamma(g.sum(1, keepdims=True)))
            norm = np.einsum("bnk,bk->bn", beta[live], theta) + 1e-100
            new = alpha[live] + theta * np.einsum("bn,bnk->bk", counts[live] / norm, beta[live])
            gamma[live] = new
            live = live[np.abs(new - g).mean(1) > 1e-3]
        return gamma

    def padded(part):
        """Counts, term rows and alpha of a slice of documents as dense arrays."""
        n = max(len(c) for c in part["counts"])
        alpha = np.stack(list(part["alpha"]))
        counts = np.zeros((len(part), n))
        beta = np.zeros((len(part), n, alpha.shape[1]))
        for i, (c, b) in enumerate(zip(part["counts"], part["beta"])):
            counts[i, : len(c)] = c
            beta[i, : len(c)] = b.reshape(len(c), -1)
        return counts, beta, alpha

    def slices(batch):
        """Documents of similar length together, at most about a million cells at a time."""
        batch = batch.iloc[np.argsort([len(c) for c in batch["counts"]], kind="stable")]
        start = 0
        while start < len(batch):
            stop = start + 1
            while stop < len(batch) and (stop + 1 - start) * len(batch["counts"].iloc[stop]) < 200_000:
                stop += 1
            yield batch.iloc[start:stop]
            start = stop

    return digamma, trigamma, lgamma, fit_documents, padded, slices


def term_vectors(rows: DataFrame, vocab: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``ids, counts`` of each comment against its video's vocabulary; empty ones are left out.

    Tokens meet the vocabulary by a join; partial lists are built where the comment lies.
    """
    spoken = rows.select(KEY, SEQ, F.explode(tokens).alias("term"))
    terms = vocab.select(KEY, "term", (F.col("rank") - 1).alias("id"))
    lists = join_lookup(spoken, terms, [KEY, "term"]).groupBy(KEY, SEQ).agg(
        F.collect_list("id").alias("ids")
    )

    def count(batches):
        for batch in batches:
            lists = batch.pop("ids")
            if not len(lists):
                continue
            ids = np.concatenate(lists.to_list()).astype(np.int64)
            row = np.repeat(np.arange(len(lists)), lists.map(len))
            width = int(ids.max(initial=0)) + 1
            pairs, counts = np.unique(row * width + ids, return_counts=True)
            cuts = np.searchsorted(pairs // width, np.arange(1, len(lists)))
            batch["ids"] = np.split(pairs % width, cuts)
            batch["counts"] = np.split(counts.astype(float), cuts)
            yield batch

    schema = f"{KEY} string, {SEQ} bigint, ids array<int>, counts array<double>"
    return lists.mapInPandas(count, schema)


def _model_schema() -> str:
    """``lam`` and ``beta`` hold one row of topic weights per term, one after the other."""
    return (
        f"{KEY} string, terms int, comments bigint, step int, "
        "lam array<double>, beta array<double>, alpha array<double>"
    )


def _first_models(sizes: DataFrame, k: int, seed: int) -> DataFrame:
    """Random starting models, one row per video, the same for any partitioning."""
    helpers = _helpers()

    def start(batches):
        digamma = helpers[0]
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                name = list(row.video_key.encode())
                lam = np.random.default_rng([seed, *name]).gamma(100.0, 0.01, (row.terms, k))
                beta = np.exp(digamma(lam) - digamma(lam.sum(0, keepdims=True)))
                out.append(
                    (row.video_key, row.terms, row.comments, 0, lam.ravel(), beta.ravel(),
                     np.full(k, 1.0 / k))
                )
            yield pd.DataFrame(out, columns=[
                "video_key", "terms", "comments", "step", "lam", "beta", "alpha"])

    return sizes.mapInPandas(start, _model_schema())


def _with_model(vectors: DataFrame, models: DataFrame, k: int, size: int) -> DataFrame:
    """Comments with the model rows of their own terms only. ``size`` is that of the models."""
    own = F.flatten(F.transform("ids", lambda i: F.slice("beta", i * k + 1, k)))
    lookup = models.select(KEY, "beta", "alpha")
    return join_lookup(vectors, lookup, KEY, size=size).select(
        KEY, "ids", "counts", own.alias("beta"), "alpha"
    )


def _statistics(sampled: DataFrame, k: int) -> DataFrame:
    """Summed statistics per video and term; term -1 holds the log topic weights and the count."""
    helpers = _helpers()

    def expect(batches):
        digamma, _, _, fit_documents, padded, slices = helpers
        names = [f"s{j}" for j in range(k)]
        for batch in batches:
            found = [pd.DataFrame(columns=["video_key", "term", "n", *names])]
            for part in slices(batch):
                counts, beta, alpha = padded(part)
                gamma = fit_documents(counts, beta, alpha)
                log_theta = digamma(gamma) - digamma(gamma.sum(1, keepdims=True))
                theta = np.exp(log_theta)
                norm = np.einsum("bnk,bk->bn", beta, theta) + 1e-100
                share = (counts / norm)[:, :, None] * theta[:, None, :] * beta
                used = counts > 0
                keys = part["video_key"].to_numpy()
                terms = [np.full(len(keys), -1), *part["ids"]]
                sums = pd.DataFrame(np.vstack([log_theta, share[used]]), columns=names)
                sums["video_key"] = np.concatenate([keys, np.repeat(keys, used.sum(1))])
                sums["term"], sums["n"] = np.concatenate(terms), 1
                found.append(sums)
            whole = pd.concat(found[1:] or found)
            yield whole.groupby(["video_key", "term"], as_index=False, sort=False).sum()

    fields = ", ".join(f"s{j} double" for j in range(k))
    partial = sampled.mapInPandas(expect, f"{KEY} string, term int, n bigint, {fields}")
    return partial.groupBy(KEY, "term").agg(
        F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(k)]
    )


def _updated(models: DataFrame, stats: DataFrame, k: int, rate: float) -> DataFrame:
    """Blend the statistics into the models; a video without sampled comments stays as it is.

    A group holds one model and at most one row per vocabulary term.
    """
    helpers = _helpers()
    offset, decay = LEARNING_OFFSET, LEARNING_DECAY

    def blend(model: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        digamma, trigamma = helpers[:2]
        if found.empty or model.empty:
            return model
        row = model.iloc[0]
        step = int(row["step"]) + 1
        weight = (offset + step) ** -decay
        values = found[[f"s{j}" for j in range(k)]].to_numpy()
        terms = found["term"].to_numpy()
        documents = terms < 0
        stat = np.zeros((int(row["terms"]), k))
        stat[terms[~documents]] = values[~documents]
        scale = row["comments"] / np.ceil(rate * row["comments"])
        lam = row["lam"].reshape(-1, k)
        lam = (1 - weight) * lam + weight * (stat * scale + 1.0 / k)
        alpha = row["alpha"]
        n = float(found["n"].to_numpy()[documents][0])
        mean_log = values[documents][0] / n
        gradient = n * (digamma(alpha.sum(keepdims=True)) - digamma(alpha) + mean_log)
        diagonal = -n * trigamma(alpha)
        common = n * trigamma(alpha.sum(keepdims=True))
        middle = (gradient / diagonal).sum() / (1 / common + (1 / diagonal).sum())
        moved = alpha - weight * (gradient - middle) / diagonal
        if (moved > 0).all():
            alpha = moved
        beta = np.exp(digamma(lam) - digamma(lam.sum(0, keepdims=True)))
        return pd.DataFrame(
            [(row["video_key"], row["terms"], row["comments"], step, lam.ravel(), beta.ravel(),
              alpha)],
            columns=["video_key", "terms", "comments", "step", "lam", "beta", "alpha"],
        )

    return (
        models.groupBy(KEY).cogroup(stats.groupBy(KEY)).applyInPandas(blend, _model_schema())
    )


def _chance(seed: int, step: int) -> Column:
    """A number in [0, 1) per comment and step, the same for any partitioning."""
    bits = F.shiftrightunsigned(F.xxhash64(KEY, SEQ, F.lit(seed), F.lit(step)), 11)
    return bits / F.lit(float(1 << 53))


def _draws(vectors: DataFrame, least: DataFrame, steps: int, rate: float, seed: int) -> DataFrame:
    """The comments of all steps from one pass over the vectors, stored by ``_step``. Videos of
    which the rate draws nothing in a step give the comment with the smallest number."""
    every = F.array(*[
        F.struct(F.lit(step).alias("step"), _chance(seed, step).alias("chance"), F.col(f"least_{step}").alias("least"))
        for step in range(steps)
    ])
    taken = F.filter(every, lambda x: (x["chance"] < rate) | ((x["least"] >= rate) & (x["chance"] == x["least"])))
    numbers = least.select(KEY, *[f"least_{step}" for step in range(steps)])
    drawn = join_lookup(vectors, numbers, KEY).select(
        *vectors.columns, F.explode(F.transform(taken, lambda x: x["step"])).alias("_step")
    )
    folder = scratch_dir(vectors.sparkSession, "drawn")
    drawn.write.partitionBy("_step").parquet(folder)
    return vectors.sparkSession.read.schema(drawn.schema).parquet(folder)


def fit_video_topics(
    rows: DataFrame,
    tokens: str = "tokens",
    k: int = NUM_TOPICS,
    max_iter: int = TOPIC_ITERATIONS,
    vocab_size: int = VOCABULARY_SIZE,
    min_df: float = MIN_DOCUMENTS,
    rate: float = SUBSAMPLING_RATE,
    seed: int = 7,
) -> VideoTopics:
    """Fit one model per video over rows with clean tokens."""
    vocab = stored(vocabulary(rows, KEY, tokens, vocab_size, min_df), "vocabulary")
    vectors = stored(term_vectors(rows, vocab, tokens), "vectors")
    sizes = vocab.groupBy(KEY).agg(F.count("*").cast("int").alias("terms"))
    comments = rows.groupBy(KEY).agg(F.count("*").alias("comments"))
    models = _first_models(sizes.join(comments, KEY).select(KEY, "terms", "comments"), k, seed)
    models = stored(models, "topics")
    size = measured_bytes(models)  # the same in every step
    drawn = [F.min(_chance(seed, step)).alias(f"least_{step}") for step in range(max_iter)]
    least = stored(vectors.groupBy(KEY).agg(F.count("*").alias("vectors"), *drawn), "draws")
    draws = _draws(vectors, least, max_iter, rate, seed)
    for step in range(max_iter):
        sampled = draws.where(F.col("_step") == step).drop("_step")
        stats = _statistics(_with_model(sampled, models, k, size), k)
        models = stored(_updated(models, stats, k, rate), "topics")
    return VideoTopics(models, vocab, vectors, k)


class VideoTopics:
    """Fitted models, vocabularies and vectors of all videos."""

    def __init__(self, models: DataFrame, vocab: DataFrame, vectors: DataFrame, k: int):
        self.models, self.vocab, self.vectors, self.k = models, vocab, vectors, k

    def topics(self, terms: int = TERMS_PER_TOPIC) -> DataFrame:
        """``video_key, topic, words, weights`` with the heaviest terms of each topic."""
        cells = self.models.select(KEY, F.posexplode("lam").alias("cell", "lam"))
        flat = cells.select(
            KEY,
            F.floor(F.col("cell") / self.k).cast("int").alias("id"),
            (F.col("cell") % self.k).alias("topic"),
            "lam",
        )
        order = Window.partitionBy(KEY, "topic").orderBy(F.desc("lam"), F.asc("id"))
        total = F.sum("lam").over(Window.partitionBy(KEY, "topic"))
        heavy = flat.withColumns(
            {"weight": F.col("lam") / total, "place": F.row_number().over(order)}
        ).where(F.col("place") <= terms)
        named = heavy.join(
            self.vocab.select(KEY, "term", (F.col("rank") - 1).alias("id")), [KEY, "id"]
        )
        ranked = F.array_sort(F.collect_list(F.struct("place", "term", "weight")))
        return named.groupBy(KEY, "topic").agg(ranked.alias("_t")).select(
            KEY,
            "topic",
            F.col("_t.term").alias("words"),
            F.col("_t.weight").alias("weights"),
        )

    def metrics(self) -> DataFrame:
        """Vocabulary size, steps the model was trained by, and the variational bound on all comments
        of each video."""
        helpers, k = _helpers(), self.k

        def score(batches):
            digamma, _, lgamma, fit_documents, padded, slices = helpers
            for batch in batches:
                out = []
                for part in slices(batch):
                    counts, beta, alpha = padded(part)
                    gamma = fit_documents(counts, beta, alpha)
                    total = gamma.sum(1, keepdims=True)
                    log_theta = digamma(gamma) - digamma(total)
                    mixed = np.einsum("bnk,bk->bn", beta, np.exp(log_theta))
                    bound = (counts * np.log(np.where(counts > 0, mixed, 1.0))).sum(1)
                    bound += ((alpha - gamma) * log_theta).sum(1)
                    bound += (lgamma(gamma) - lgamma(alpha)).sum(1)
                    bound += lgamma(alpha.sum(1)) - lgamma(total[:, 0])
                    out += zip(part["video_key"], bound.tolist(), counts.sum(1).tolist())
                yield pd.DataFrame(out, columns=["video_key", "bound", "tokens"])

        def score_topics(batches):
            digamma, _, lgamma = helpers[:3]
            for batch in batches:
                out = []
                for key, step, flat in zip(batch["video_key"], batch["step"], batch["lam"]):
                    lam = flat.reshape(-1, k)
                    eta, total = 1.0 / k, lam.sum(0)
                    log_beta = digamma(lam) - digamma(total)[None, :]
                    bound = ((eta - lam) * log_beta).sum() + lgamma(lam).sum()
                    bound -= lam.size * lgamma(np.array([eta]))[0]
                    bound += k * lgamma(np.array([eta * len(lam)]))[0] - lgamma(total).sum()
                    out.append((key, len(lam), step, float(bound)))
                yield pd.DataFrame(out, columns=["video_key", "vocabulary_size", "steps", "topic_bound"])

        documents = (
            _with_model(self.vectors, self.models, k, measured_bytes(self.models))
            .mapInPandas(score, f"{KEY} string, bound double, tokens double")
            .groupBy(KEY)
            .agg(F.sum("bound").alias("bound"), F.sum("tokens").alias("tokens"))
        )
        topics = self.models.select(KEY, "step", "lam").mapInPandas(
            score_topics, f"{KEY} string, vocabulary_size bigint, steps int, topic_bound double"
        )
        likelihood = F.col("bound") + F.col("topic_bound")
        return topics.join(documents, KEY).select(
            KEY,
            "vocabulary_size",
            "steps",
            likelihood.alias("log_likelihood"),
            (-likelihood / F.col("tokens")).alias("log_perplexity"),
        )

    def skipped(self, comments: DataFrame, rows: DataFrame) -> DataFrame:
        """Videos without a model and why; ``rows`` are the comments with tokens."""
        return skipped_videos(comments, rows, self.vocab)
