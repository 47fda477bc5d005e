"""The jobs in the order a user runs them, over landed files."""

import json

import pytest
from test_sources import comment, land, raw_video

from reelgauge import jobs
from reelgauge.sources import comments as C


def thread(author, text, at):
    inner = {"authorDisplayName": author, "textDisplay": text, "likeCount": 1, "publishedAt": at}
    return {"snippet": {"topLevelComment": {"snippet": inner}}}


def test_from_landing_to_reports(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "get_session", lambda name: spark)
    out = {n: str(tmp_path / n) for n in ("selected", "comments", "reports")}
    search = land(tmp_path, "search", [{"items": [{"id": {"videoId": v}} for v in "ab"]}])
    videos = land(tmp_path, "videos", [{"items": [
        raw_video("a", "Kong Official Trailer", "Netflix", viewCount=1200, likeCount=7),
        raw_video("b", "Sea New Trailer", "DC", viewCount=900, likeCount=9),
    ]}])
    first = land(tmp_path, "day1", [
        {"video_id": "a", "status": "ok", "items": [thread("x", "great great film", f"2025-01-0{i}") for i in range(1, 7)]},
    ])
    second = land(tmp_path, "day2", [
        {"video_id": "a", "status": "ok", "items": [thread("y", "bad, mail a@b.org", "2025-02-01"), thread("x", "old", "2025-01-01")]},
        {"video_id": "b", "status": "videoNotFound", "items": []},
    ])
    one, two = "20250125_150835", "20250126_150835"
    jobs.main(["select", "--search", search, "--videos", videos, "--out", out["selected"], "--run-id", one])
    base = ["--selected", out["selected"], "--comments", out["comments"]]
    jobs.main(["merge", "--threads", first, *base, "--run-id", one])
    jobs.main(["merge", "--threads", second, *base, "--run-id", two])
    assert C.read_comments(spark, out["comments"]).count() == 7
    assert C.read_comments(spark, out["comments"], one).count() == 6
    for job in ("sentiment", "entities", "topics"):
        jobs.main([job, "--comments", out["comments"], "--out", out["reports"], "--run-id", two])
    jobs.main(["board", *base, "--out", out["reports"], "--run-id", two, "--query", "trailer"])

    def lines(path):
        return [json.loads(r[0]) for r in spark.read.text(f"{out['reports']}/{path}").collect()]

    report = lines(f"sentiment_analysis_{two}/videos")[0]
    assert report["sentiment_stats"]["sentiment_distribution"]["positive"]["count"] == 6
    assert report["sentiment_examples"]["negative"] == "bad, mail a@b.org"
    found = lines(f"entity_analysis_{two}/videos")[0]
    assert found["top_entities"] == [{"text": "a@b.org", "type": "EMAIL", "count": 1}]
    header = lines(f"topic_analysis_{two}/header")[0]
    assert header == {"analysis_timestamp": "2025-01-26 15:08:35", "total_videos_analyzed": 1}
    topics = lines(f"topic_analysis_{two}/videos")[0]
    assert topics["vocabulary_size"] == 2 and len(topics["topics"]) == 5
    board = lines(f"leaderboard_{two}")
    assert [(r["title"], r["sentiment"]) for r in board] == [
        ("sea new trailer", None), ("kong official trailer", "positive"),
    ]


def test_convert_and_ingest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "get_session", lambda name: spark)
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "kong_a_comments.json").write_text(json.dumps([comment("x", "hi")]))
    dst = str(tmp_path / "converted")
    jobs.main(["convert", "--landing", str(folder), "--comments", dst, "--run-id", "20250101_000000"])
    assert C.read_comments(spark, dst).first()["video_key"] == "kong_a"
    target = str(tmp_path / "stream")
    jobs.main(["ingest", "--landing", str(folder), "--comments", target, "--progress",
               str(tmp_path / "progress"), "--run-id", "20250101_000000"])
    assert [r["video_key"] for r in C.read_comments(spark, target).collect()] == ["kong_a"]


def test_sentiment_over_a_folder_per_video(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "get_session", lambda name: spark)
    data = spark.createDataFrame(
        [("a", "great", 1, "p"), ("b", "bad", 1, "p"), ("c", "great", 1, "p")],
        "author string, text string, like_count int, published_at string",
    )
    root = str(tmp_path / "parquet")
    data.limit(1).write.parquet(f"{root}/20250101_000000/kong_a_comments.parquet")
    data.write.parquet(f"{root}/20250102_000000/kong_a_comments.parquet")
    base = ["sentiment", "--folders", "--comments", root, "--out", str(tmp_path / "out")]
    jobs.main([*base, "--run-id", "20250103_000000"])
    jobs.main([*base, "--run-id", "20250104_000000", "--snapshot", "20250101_000000"])
    for run, count in (("20250103_000000", 3), ("20250104_000000", 1)):
        table = spark.read.parquet(f"{tmp_path}/out/sentiment_analysis_{run}/table")
        assert [(r[0], r[1]) for r in table.collect()] == [("kong_a", count)]


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        jobs.parse(["sentiment", "--out", "x"])
