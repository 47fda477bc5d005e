import math
import random
from functools import partial

import numpy as np
import pytest

from reelgauge.operators import tokens as K
from reelgauge.operators import topics as G
from reelgauge.operators import video_topics as VT
from reelgauge.plans.reports import topic_report

PETS = ["cat", "dog", "bird", "fish"]
CARS = ["wheel", "motor", "brake", "gear"]


def corpus(key, n, seed=1):
    pick = random.Random(seed)
    sides = [PETS, CARS]
    return [(key, i, [pick.choice(sides[i % 2]) for _ in range(12)]) for i in range(n)]


@pytest.fixture
def token_rows(spark):
    data = corpus("hot", 200) + corpus("v", 40, 2) + [("rare", 0, ["one"]), ("rare", 1, ["two"])]
    return spark.createDataFrame(data, "video_key string, arrival_seq bigint, tokens array<string>")


def test_vocabulary_counts_rows_and_occurrences(spark, rows):
    frame = spark.createDataFrame(
        [("a", ["x", "x", "y"]), ("a", ["x", "z"]), ("b", ["x"])], "video_key string, tokens array<string>"
    )
    assert rows(K.term_counts(frame)) == [("x", 4, 3), ("y", 1, 1), ("z", 1, 1)]
    assert rows(K.vocabulary(frame, size=2, min_documents=1)) == [("x", 4, 3, 1), ("y", 1, 1, 2)]
    assert rows(K.vocabulary(frame, "video_key", min_documents=2)) == [("a", "x", 3, 2, 1)]
    assert rows(K.vocabulary_size(K.vocabulary(frame, "video_key", min_documents=1), "video_key")) == [
        ("a", 3), ("b", 1),
    ]


def test_rows_without_tokens_are_dropped(spark, rows):
    frame = spark.createDataFrame([("the and",), ("cat",), (None,), ("",)], "text string")
    assert rows(K.with_tokens(frame), "tokens") == [(["cat"],)]


def test_numeric_helpers():
    digamma, trigamma, lgamma = VT._helpers()[:3]
    x = np.array([0.05, 0.2, 1.0, 3.7, 50.0])
    assert np.allclose(lgamma(x), [math.lgamma(v) for v in x], rtol=0, atol=1e-10)
    step = 1e-5
    slope = [(math.lgamma(v + step) - math.lgamma(v - step)) / (2 * step) for v in x]
    assert np.allclose(digamma(x), slope, rtol=1e-5)
    bend = (digamma(x + step) - digamma(x - step)) / (2 * step)
    assert np.allclose(trigamma(x), bend, rtol=1e-5)


def test_every_video_gets_its_own_separated_topics(token_rows):
    model = VT.fit_video_topics(token_rows, k=2, max_iter=12, rate=1.0)
    topics = model.topics(4).collect()
    assert {(r["video_key"], r["topic"]) for r in topics} == {
        ("hot", 0), ("hot", 1), ("v", 0), ("v", 1),
    }
    for r in topics:
        assert set(r["words"]) in (set(PETS), set(CARS))
        assert list(r["weights"]) == sorted(r["weights"], reverse=True)
    assert [tuple(r) for r in model.skipped(token_rows, token_rows).collect()] == [
        ("rare", "no frequent term")
    ]
    metrics = {r["video_key"]: r for r in model.metrics().collect()}
    assert metrics["hot"]["vocabulary_size"] == 8
    assert metrics["hot"]["log_perplexity"] < math.log(8)


def test_fits_repeat_for_any_partitioning(token_rows):
    def fit(frame):
        return sorted(
            (r["video_key"], r["topic"], tuple(r["words"]))
            for r in VT.fit_video_topics(frame, k=2, max_iter=4, rate=0.3).topics().collect()
        )

    assert fit(token_rows) == fit(token_rows.repartition(3)) == fit(token_rows.coalesce(1))


def test_models_beyond_the_broadcast_limit(token_rows, monkeypatch):
    def fit():
        model = VT.fit_video_topics(token_rows, k=2, max_iter=3, rate=0.5)
        topics = sorted((r[0], r[1], tuple(r[2])) for r in model.topics().collect())
        return topics, sorted((r[0], round(r[2], 6)) for r in model.metrics().collect())

    near = fit()
    monkeypatch.setattr(VT, "join_lookup", partial(VT.join_lookup, limit_bytes=-1))
    assert fit() == near


def test_bound_equals_mllibs_on_the_same_model(spark, token_rows):
    one = token_rows.where("video_key = 'hot'")
    theirs = G.fit_topics(one, k=2, max_iter=5)
    ours = VT.fit_video_topics(one, k=2, max_iter=1)
    lam = theirs.lda.topicsMatrix().toArray()
    digamma = VT._helpers()[0]
    beta = np.exp(digamma(lam) - digamma(lam.sum(0, keepdims=True)))
    alpha = [float(a) for a in theirs.lda.estimatedDocConcentration()]
    row = ("hot", len(lam), 200, 0, lam.ravel().tolist(), beta.ravel().tolist(), alpha)
    assert [r["term"] for r in ours.vocab.orderBy("rank").collect()] == theirs.words
    same = VT.VideoTopics(
        spark.createDataFrame([row], VT._model_schema()), ours.vocab, ours.vectors, 2
    )
    want, got = G.topic_metrics(theirs).first(), same.metrics().first()
    assert got["vocabulary_size"] == want["vocabulary_size"] == 8
    assert got["log_likelihood"] == pytest.approx(want["log_likelihood"], rel=1e-6)
    assert got["log_perplexity"] == pytest.approx(want["log_perplexity"], rel=1e-6)


def test_quality_is_close_to_mllibs(token_rows):
    one = token_rows.where("video_key = 'hot'")
    own = VT.fit_video_topics(one, k=2, max_iter=10, rate=1.0).metrics().first()
    ref = G.topic_metrics(G.fit_topics(one, k=2, max_iter=10)).first()
    assert own["log_perplexity"] < ref["log_perplexity"] + 0.3


def test_global_topics(token_rows, rows):
    model = G.fit_topics(token_rows, k=2, max_iter=10)
    again = G.fit_topics(token_rows, k=2, max_iter=10)
    words = rows(G.topic_words(model), "topic", "words")
    assert words == rows(G.topic_words(again), "topic", "words")
    assert all(len(w) == len(set(w)) <= 10 and set(w) <= set(model.words) for _, w in words)
    mixture = G.topic_mixture(model).groupBy("video_key").sum("weight").collect()
    assert all(r[1] == pytest.approx(1.0) for r in mixture)
    assert {r[0] for r in mixture} == {"hot", "v"}
    with pytest.raises(ValueError, match="no term"):
        G.fit_topics(token_rows.where("video_key = 'rare'"))


def test_mixture_infers_each_row_once(token_rows, rows):
    model = G.fit_topics(token_rows, k=2, max_iter=2)
    mixture = G.topic_mixture(model)
    plan = mixture._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    assert plan.count("UDF(features") == 1
    weights = model.lda.transform(model.vectors).select("video_key", "topicDistribution").collect()
    weights = [(k, w) for k, w in weights if max(w) > 0]
    assert {k for k, _ in weights} == {"hot", "v"}
    want = {
        (key, i): (np.mean([w[i] for k, w in weights if k == key]), sum(k == key for k, _ in weights))
        for key in ("hot", "v") for i in range(2)
    }
    found = {(r["video_key"], r["topic"]): r for r in mixture.collect()}
    assert found.keys() == want.keys()
    for at, (weight, comments) in want.items():
        assert found[at]["weight"] == pytest.approx(weight)
        assert found[at]["comments"] == comments


def test_small_videos_are_trained_in_every_step(spark):
    data = [r for i in range(60) for r in corpus(f"v{i}", 5, i)]
    rows = spark.createDataFrame(data, "video_key string, arrival_seq bigint, tokens array<string>")
    model = VT.fit_video_topics(rows, k=2, min_df=2, max_iter=3)
    steps = [r["steps"] for r in model.metrics().collect()]
    assert steps == [3] * 60


def test_nothing_to_fit(token_rows):
    model = VT.fit_video_topics(token_rows.where("video_key = 'rare'"), max_iter=2)
    assert model.topics().count() == model.metrics().count() == 0


def test_report(token_rows):
    model = VT.fit_video_topics(token_rows, k=3, max_iter=2)
    report = topic_report(token_rows, model.topics(), model.metrics()).collect()
    assert {r["video_key"] for r in report} == {"hot", "v"}
    one = next(r for r in report if r["video_key"] == "v")
    assert one["total_comments"] == 40 and one["vocabulary_size"] == 8
    assert [t["topic_id"] for t in one["topics"]] == [0, 1, 2]


def test_summary_takes_five_words(spark):
    frame = spark.createDataFrame([(0, list("abcdefg"))], "topic int, words array<string>")
    assert G.topic_summary(frame).first()["summary"] == "a, b, c, d, e"
