"""Scalar functions against Python's own behaviour and hand-written cases."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from reelgauge.functions import fixed
from reelgauge.functions import text as T
from reelgauge.functions import values as N


def apply(spark, values, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_stop_words_are_sparks(spark):
    assert fixed.STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_movie_key(spark):
    titles = ["My Film Trailer 2 trailer", "Trailer X", "Nofilm", "  Pad  TRAILER"]
    assert apply(spark, titles, T.movie_key("v")) == ["my film", "", "nofilm", "pad"]


def test_video_key(spark):
    key = T.video_key(F.col("v"), F.lit("a-B_c"))
    assert apply(spark, ["super-man_2: official!"], key) == ["superman2_official_a-B_c"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"], exclude_characters="\x00"), max_size=12), min_size=30, max_size=60))
def test_strip_and_key_follow_python(spark, values):
    assert apply(spark, values, T.strip("v")) == [v.strip() for v in values]
    want = [
        "".join(c for c in v if c.isalnum() or c.isspace()).replace(" ", "_") + "_id" for v in values
    ]
    got = apply(spark, values, T.video_key(F.col("v"), F.lit("id")))
    # Number forms such as superscripts differ in Unicode category only.
    odd = [any(unicodedata.category(c) == "No" for c in v) for v in values]
    assert [g for g, o in zip(got, odd) if not o] == [w for w, o in zip(want, odd) if not o]


def test_has_text(spark):
    assert apply(spark, [None, "", " ", "a"], T.has_text("v")) == [False, False, True, True]


def by_token(text, lower=False):
    tokens = re.split(r"\s+", text)
    letters = ["".join(c for c in t if c.isalpha() or c == "+") for t in tokens]
    kept = [t for t in letters if t and t.lower() not in set(fixed.STOP_WORDS)]
    return [t.lower() for t in kept] if lower else kept


@pytest.mark.parametrize("lower", [False, True])
def test_clean_tokens_equal_token_by_token_cleaning(spark, lower):
    texts = ["The  cat's 2 hats,\tARE red!", " ", "C++ a1b2 ... é-à", "don't stop", "x\n\ny"]
    assert apply(spark, texts, T.clean_tokens("v", lower=lower)) == [
        by_token(t, lower) for t in texts
    ]


def test_tag_type(spark):
    tags = ["B-PER", "PER", "B-X-Y"]
    assert apply(spark, tags, T.tag_type("v")) == ["PER", "PER", "X"]


def test_contains_text(spark):
    assert apply(spark, ["Hot Rod", "cold"], T.contains_text("v", "hOT")) == [True, False]
    assert apply(spark, ["Hot Rod", "cold"], T.contains_text("v", "")) == [True, True]


def test_counts(spark):
    assert apply(spark, ["7", None], N.count_or_zero(F.col("v"))) == [7, 0]
    assert apply(spark, ["x"], N.count_or_zero(F.col("v"), strict=False)) == [0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, ["x"], N.count_or_zero(F.col("v")))


def test_percentage_keeps_operation_order(spark):
    part = F.lit(1).cast("bigint")
    assert apply(spark, ["a"], N.percentage(part, F.lit(3).cast("bigint"))) == [(1 / 3) * 100]
    assert apply(spark, ["a"], N.percentage(part, F.lit(0).cast("bigint"))) == [0.0]


def test_times(spark):
    moment = F.col("v").cast("timestamp_ntz")
    at = ["2025-01-25 15:08:35"]
    assert apply(spark, at, N.run_id(moment)) == ["20250125_150835"]
    assert apply(spark, at, N.report_time(moment)) == at
    assert apply(spark, at, N.days_before(moment, 90)) == ["2024-10-27T15:08:35.000000Z"]
