import random
from collections import defaultdict

import pytest

from reelgauge.functions.fixed import LABELS
from reelgauge.operators import sentiment as S
from reelgauge.plans.reports import sentiment_report

ROWS = [
    ("a", 0, "Great film"), ("a", 1, "bad BAD good"), ("a", 2, "so so"), ("a", 3, None),
    ("a", 4, ""), ("a", 5, " "), ("a", 6, "great"), ("b", 0, None), ("c", 0, "bad"),
]


@pytest.fixture
def comments(spark):
    return spark.createDataFrame(ROWS, "video_key string, arrival_seq bigint, text string")


@pytest.fixture
def lexicon(spark):
    return S.Lexicon(
        spark.createDataFrame([("great", 2), ("good", 1), ("Good", 1), ("bad", -1)], "term string, polarity int")
    )


def test_labels(comments, lexicon, rows):
    labelled = S.label_sentiment(comments, lexicon)
    want = [
        ("a", 0, "positive", 1.0), ("a", 1, "negative", 1.0), ("a", 2, "neutral", 1.0),
        ("a", 3, None, None), ("a", 4, None, None), ("a", 5, "neutral", 1.0),
        ("a", 6, "positive", 1.0), ("b", 0, None, None), ("c", 0, "negative", 1.0),
    ]
    assert rows(labelled, "video_key", "arrival_seq", "sentiment", "confidence") == want


def test_large_lexicon_takes_the_join_and_agrees(comments, lexicon, rows, monkeypatch):
    small = rows(S.label_sentiment(comments, lexicon))
    monkeypatch.setattr(S.Lexicon, "INLINE_TERMS", 1)
    assert rows(S.label_sentiment(comments, lexicon).select(*comments.columns, "sentiment", "confidence")) == small


def test_distribution_and_totals(comments, lexicon, rows):
    counts = S.sentiment_counts(S.label_sentiment(comments, lexicon))
    shares = {(r[0], r[1]): r[2:] for r in rows(S.sentiment_distribution(counts), "video_key", "sentiment", "total_comments", "total_analyzed", "count", "percentage", "average_confidence")}
    assert shares == {
        ("a", "positive"): (7, 5, 2, 40.0, 1.0),
        ("a", "negative"): (7, 5, 1, 20.0, 1.0),
        ("a", "neutral"): (7, 5, 2, 40.0, 1.0),
        ("c", "negative"): (1, 1, 1, 100.0, 1.0),
    }
    assert rows(S.sentiment_totals(counts)) == [("a", 7, 5, 1.0), ("b", 1, 0, 0.0), ("c", 1, 1, 1.0)]


def test_examples(comments, lexicon, rows):
    labelled = S.label_sentiment(comments, lexicon)
    assert rows(S.sentiment_examples(labelled), "video_key", *LABELS) == [
        ("a", "Great film", "bad BAD good", "so so"), ("b", None, None, None),
        ("c", None, "bad", None),
    ]


def test_counts_do_not_depend_on_partitioning(comments, lexicon, rows):
    want = rows(S.sentiment_counts(S.label_sentiment(comments, lexicon)))
    assert rows(S.sentiment_counts(S.label_sentiment(comments.repartition(5), lexicon))) == want
    assert rows(S.sentiment_counts(S.label_sentiment(comments.coalesce(1), lexicon))) == want


def test_report_keeps_videos_without_usable_text(comments, lexicon):
    report = {r["video_key"]: r for r in sentiment_report(comments, lexicon).collect()}
    assert set(report) == {"a", "b", "c"}
    none = report["b"]
    assert none["total_comments"] == 1
    assert none["sentiment_stats"].asDict() == {
        "total_analyzed": 0, "sentiment_distribution": {}, "average_confidence": 0.0,
    }
    assert none["sentiment_examples"]["positive"] is None
    assert report["a"]["sentiment_stats"]["sentiment_distribution"]["neutral"]["count"] == 2


def test_dominant_label_ties_go_by_name(spark, rows):
    counts = spark.createDataFrame(
        [("a", "positive", 2), ("a", "neutral", 2), ("a", None, 9), ("b", "negative", 1)],
        "video_key string, sentiment string, count bigint",
    )
    assert rows(S.dominant_sentiment(counts)) == [("a", "neutral", 2), ("b", "negative", 1)]


def test_hook_defaults_and_lower_case(comments, rows):
    def load():
        return lambda texts: [None if "so" in t else "POSITIVE" for t in texts]

    got = S.label_sentiment(comments, S.Hook(load, batch_size=2))
    assert [r[2] for r in rows(got, "video_key", "arrival_seq", "sentiment")] == [
        "positive", "positive", "neutral", None, None, "positive", "positive", None, "positive",
    ]


def test_trained_scorer_learns_a_clear_split(spark):
    texts = [("lovely sunny day %d" % i, "positive") for i in range(30)]
    texts += [("dreadful rainy mess %d" % i, "negative") for i in range(6)]
    texts += [("plain table chair %d" % i, "neutral") for i in range(30)]
    known = spark.createDataFrame(
        [("v", i, t, s) for i, (t, s) in enumerate(texts)],
        "video_key string, arrival_seq bigint, text string, sentiment string",
    )
    scorer = S.train_sentiment(known, features=1 << 10)
    found = S.label_sentiment(known.withColumnRenamed("sentiment", "truth"), scorer)
    assert found.where("truth <> sentiment").count() == 0
    low, high = found.selectExpr("min(confidence)", "max(confidence)").first()
    assert 1 / 3 < low <= high <= 1
    assert scorer.label(known.limit(0), "text").count() == 0


def test_both_lexicon_forms_agree_on_nulls(spark, rows, monkeypatch):
    terms = spark.createDataFrame(
        [("good", 1), ("bad", -1), (None, 1), ("odd", None)], "term string, polarity int"
    )
    frame = spark.createDataFrame(
        [(None, 0, "good odd"), ("v", None, "bad"), ("v", 1, None), ("v", 2, "good bad good")],
        "video_key string, arrival_seq bigint, text string",
    )
    inline = rows(S.Lexicon(terms).label(frame, "text"))
    monkeypatch.setattr(S.Lexicon, "INLINE_TERMS", 0)
    assert rows(S.Lexicon(terms).label(frame, "text")) == inline
    assert [r[-1] for r in inline].count("positive") == 2


def test_embeddings_are_mean_vectors_of_one_width(spark):
    frame = spark.createDataFrame(
        [("v", i, "red blue green " * 5) for i in range(20)] + [("v", 99, None)],
        "video_key string, arrival_seq bigint, text string",
    )
    got = S.sentence_embeddings(frame, size=8).collect()
    assert len(got) == 21 and {len(r["embedding"]) for r in got} == {8}


def test_shares_of_random_comments(spark, lexicon):
    pick = random.Random(3)
    words = ["great", "good", "bad", "film", ""]
    data = []
    for i in range(3000):
        key = "hot" if pick.random() < 0.34 else f"v{pick.randrange(50)}"
        text = " ".join(pick.choices(words, k=pick.randrange(4)))
        data.append((key, i, None if pick.random() < 0.1 else text))
    frame = spark.createDataFrame(data, "video_key string, arrival_seq bigint, text string")
    counts = S.sentiment_counts(S.label_sentiment(frame, lexicon))
    totals = {r["video_key"]: r for r in S.sentiment_totals(counts).collect()}
    shares, analysed = defaultdict(float), defaultdict(int)
    for r in S.sentiment_distribution(counts).collect():
        shares[r["video_key"]] += r["percentage"]
        analysed[r["video_key"]] += r["count"]
        assert r["total_comments"] == totals[r["video_key"]]["total_comments"]
    assert all(abs(s - 100) < 1e-9 for s in shares.values())
    for key, row in totals.items():
        usable = [t for k, _, t in data if k == key and t]
        assert analysed[key] == row["total_analyzed"] == len(usable) <= row["total_comments"]
    first = {r["video_key"]: r for r in S.sentiment_examples(S.label_sentiment(frame, lexicon)).collect()}
    score = {"great": 2, "good": 1, "bad": -1}
    for label, wanted in (("positive", 1), ("negative", -1), ("neutral", 0)):
        for key in totals:
            texts = [t for k, _, t in data if k == key and t]
            sums = [sum(score.get(w, 0) for w in t.split()) for t in texts]
            found = [t for t, s in zip(texts, sums) if (s > 0) - (s < 0) == wanted]
            assert first[key][label] == (found[0] if found else None)
