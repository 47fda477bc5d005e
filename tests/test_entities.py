import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reelgauge.functions import text as T
from reelgauge.operators import entities as E
from reelgauge.plans import catalog
from reelgauge.plans.reports import entity_report

MENTION = "video_key string, arrival_seq bigint, pos bigint, text string, type string"
COMMENT = "video_key string, arrival_seq bigint, text string"


def test_mentions_of_tagged_tokens(spark, rows):
    tagged = spark.createDataFrame(
        [
            ("v", 0, ["Ann", "Lee", "x"], ["B-PER", "I-PER", "O"]),
            ("v", 1, ["Bo", "Ny"], ["B-X-Y"]),
            ("v", 2, ["Oslo"], ["LOC"]),
            ("v", 3, None, None),
        ],
        "video_key string, arrival_seq bigint, token array<string>, ner array<string>",
    )
    assert rows(E.entity_mentions(tagged)) == [
        ("v", 0, 0, "ann", "PER"), ("v", 0, 1, "lee", "PER"), ("v", 1, 0, "bo", "X"),
        ("v", 2, 0, "oslo", "LOC"),
    ]


def test_tags_by_expression_of_texts_without_tokens(spark, rows, tmp_path):
    texts = ["Ann has 12 dots. last", "", None, " \n ", "One"]
    documents = [(i, t, "en", "v", 0) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(documents, schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(catalog.bio_flatten(spark, str(tmp_path))) == [
        ("v", 0, 0, "ann", "CAP"), ("v", 0, 2, "12", "NUM"), ("v", 0, 3, "dots.", "END"),
    ]


def test_name_tokens_are_runs_of_letters_and_digits(spark):
    chance = random.Random(2)
    letters = [chr(c) for c in [*range(1, 700), *range(0x300, 0x310), 0x663, 0x2028, 0x3000, 0x4E00, 0x1D504, 0x1F600]]
    texts = [None, "", " ", "--", " a-b, c\n"] + ["".join(chance.choices(letters, k=chance.randrange(30))) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = T.raw_tokens(F.regexp_replace("text", r"(?U)[^\p{L}\p{N}\s]+", " "))
    assert frame.where(~E.name_tokens("text").eqNullSafe(plain)).count() == 0
    assert frame.select(E.name_tokens("text").alias("t")).where("t = array('a', 'b', 'c')").count() == 1


def test_type_is_the_last_seen_and_ties_go_by_first_appearance(spark, rows):
    mentions = spark.createDataFrame(
        [
            ("v", 5, 0, "apple", "MISC"), ("v", 1, 3, "apple", "ORG"),
            ("v", 1, 1, "b", "LOC"), ("v", 9, 0, "b", "LOC"),
            ("v", 1, 2, "a", "LOC"), ("v", 1, 9, "a", "LOC"), ("w", 0, 0, "z", "PER"),
        ],
        MENTION,
    )
    top = E.top_entities(E.entity_counts(mentions))
    assert rows(top) == [
        ("v", 1, "b", "LOC", 2), ("v", 2, "a", "LOC", 2), ("v", 3, "apple", "MISC", 2),
        ("w", 1, "z", "PER", 1),
    ]


def test_types_outside_the_top_are_absent(spark):
    mentions = [("v", i, 0, f"e{i:02d}", "LOC") for i in range(10) for _ in (0, 1)]
    mentions.append(("v", 99, 0, "late", "RARE"))
    counts = E.entity_counts(spark.createDataFrame(mentions, MENTION))
    by_type = E.entities_by_type(E.top_entities(counts)).first()["entities_by_type"]
    assert set(by_type) == {"LOC"}
    assert [e["text"] for e in by_type["LOC"]] == [f"e{i:02d}" for i in range(10)]


@pytest.fixture
def comments(spark):
    return spark.createDataFrame(
        [
            ("v", 0, "Rome, rome and PARIS!"), ("v", 1, None), ("v", 2, ""),
            ("v", 3, "mail a.b@c.org or 10.0.0.1; call +1 (499) 555-6503"), ("w", 0, "nothing"),
        ],
        COMMENT,
    )


def test_gazetteer(spark, comments, rows, monkeypatch):
    terms = spark.createDataFrame([("Rome", "LOC"), ("paris", "LOC"), ("ROME", "ORG"), ("Rome", "LOC")], "term string, type string")
    want = [("v", 0, 0, "rome", "LOC"), ("v", 0, 1, "rome", "LOC"), ("v", 0, 3, "paris", "LOC")]
    assert rows(E.tag_entities(comments, E.Gazetteer(terms))) == want
    exact = E.tag_entities(comments, E.Gazetteer(terms, case_sensitive=True))
    assert rows(exact) == want[:1]


def test_patterns_in_text_order(comments, rows):
    assert rows(E.tag_entities(comments, E.Patterns())) == [
        ("v", 3, 0, "a.b@c.org", "EMAIL"), ("v", 3, 1, "10.0.0.1", "IP"),
        ("v", 3, 2, "+1 (499) 555-6503", "PHONE"),
    ]


def test_hook_tags_each_comment_alone(comments, rows):
    def load():
        return lambda texts: [(t.split(), ["B-W"] * len(t.split())) for t in texts]

    found = E.tag_entities(comments.where("video_key = 'w'"), E.Hook(load, batch_size=1))
    assert rows(found) == [("w", 0, 0, "nothing", "W")]


def test_report_keeps_videos_without_mentions(comments):
    report = {r["video_key"]: r for r in entity_report(comments, E.Patterns(), 2).collect()}
    assert report["v"]["total_comments"] == report["v"]["processed_comments"] == 4
    assert report["v"]["total_entities"] == 3
    assert [tuple(e) for e in report["v"]["top_entities"]] == [
        ("a.b@c.org", "EMAIL", 1), ("10.0.0.1", "IP", 1),
    ]
    assert set(report["v"]["entities_by_type"]) == {"EMAIL", "IP"}
    assert report["w"]["total_entities"] == 0
    assert report["w"]["top_entities"] == [] and report["w"]["entities_by_type"] == {}


def test_random_mentions_equal_a_counter(spark):
    pick = random.Random(5)
    data = []
    for i in range(3000):
        key = "hot" if pick.random() < 0.34 else f"v{pick.randrange(30)}"
        text = f"e{int(pick.expovariate(0.15))}"
        data.append((key, i // 3, i % 3, text, pick.choice(["A", "B"])))
    got = defaultdict(list)
    ranked = E.top_entities(E.entity_counts(spark.createDataFrame(data, MENTION)))
    for r in ranked.orderBy("video_key", "rank").collect():
        got[r["video_key"]].append((r["rank"], r["text"], r["type"], r["count"]))
    for key in {d[0] for d in data}:
        own = [d for d in data if d[0] == key]
        types = {d[3]: d[4] for d in own}
        top = Counter(d[3] for d in own).most_common(10)
        assert got[key] == [(i + 1, t, types[t], n) for i, (t, n) in enumerate(top)]


def test_hook_gets_few_bytes_at_once(spark):
    """A batch of long texts goes to the model in parts, a longer text alone."""
    sizes = [400_000, 500_000, 300_000, 2_000_000, 3, 900_000, 10]
    frame = spark.createDataFrame([("v", i, "x" * n) for i, n in enumerate(sizes)], "video_key string, arrival_seq bigint, text string").coalesce(1)

    def load():
        return lambda texts: [([str(len(t)), str(sum(map(len, texts))), str(len(texts))], ["N", None, "N"]) for t in texts]

    got = {r["arrival_seq"]: (r["token"], r["ner"]) for r in E.Hook(load, batch_size=2).tag(frame, "text").collect()}
    assert [int(got[i][0][0]) for i in range(len(sizes))] == sizes
    assert all((int(total) <= E.TEXT_BYTES or n == "1") and int(n) <= 2 for (_, total, n), _ in got.values())
    assert got[0][1] == ["N", None, "N"]
