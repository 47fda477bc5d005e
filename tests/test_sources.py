import json
import os

import pytest
from pyspark.sql import functions as F

from reelgauge.operators import sentiment as S
from reelgauge.operators.snapshots import latest_snapshot
from reelgauge.plans.collection import collect_comments, collect_videos
from reelgauge.plans.reports import sentiment_report
from reelgauge.schemas import COMMENT_ROW, SEARCH_PAGE, THREAD_PAGE, VIDEO_PAGE
from reelgauge.session import shared_dir
from reelgauge.sources import comments as C
from reelgauge.sources import landing as L
from reelgauge.sources import metadata as D
from reelgauge.sources import reports as W
from reelgauge.streaming.ingest import ingest_stream, stored_comments


def comment(author, text, likes=0, at="2025-01-01T00:00:00Z"):
    return {"author": author, "text": text, "like_count": likes, "published_at": at}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    files = {
        "film_a1_comments.json": [comment("ann", "übung", 3), comment("bob", "", 3000000000)],
        "früh_b2_comments.json": [comment("cy", 5)],
        "empty_c3_comments.json": [],
        "noname.json": [comment("x", "lost")],
        "notes.txt": [comment("x", "skipped")],
    }
    for name, content in files.items():
        (folder / name).write_text(json.dumps(content, ensure_ascii=False, indent=1))
    (folder / "cut_d4_comments.json").write_text('[{"author": "a", "te')
    return str(folder)


def test_json_to_parquet(spark, landing, tmp_path, rows):
    dst, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    C.json_to_parquet(spark, landing, dst, "20250101_000000", rejects)
    got = C.read_comments(spark, dst)
    assert got.columns == COMMENT_ROW.names
    assert rows(got, "video_key", "author", "text", "like_count", "snapshot") == [
        ("film_a1", "ann", "übung", 3, "20250101_000000"),
        ("film_a1", "bob", "", None, "20250101_000000"),
        ("früh_b2", "cy", "5", 0, "20250101_000000"),
    ]
    order = got.where("video_key = 'film_a1'").orderBy("arrival_seq").select("author")
    assert [r[0] for r in order.collect()] == ["ann", "bob"]
    bad = spark.read.json(rejects).collect()
    assert len(bad) == 1 and "cut_d4" in bad[0]["input_file"]


def test_json_lines_of_arrays(spark, tmp_path, rows):
    folder = tmp_path / "lines"
    folder.mkdir()
    pages = [[comment("a", "1"), comment("b", "2")], [comment("c", "3")]]
    text = "\n".join([*map(json.dumps, pages), '[{"broken'])
    (folder / "v_1_comments.json").write_text(text)
    landed = C.read_landed_comments(spark, str(folder), multiline=False)
    assert rows(C.good_comments(landed), "author", "video_key") == [
        ("a", "v_1"), ("b", "v_1"), ("c", "v_1"),
    ]
    assert C.rejected_files(spark, str(folder), multiline=False).count() == 1


@pytest.mark.parametrize("by_video", [False, True])
def test_snapshots_are_kept_apart(spark, tmp_path, by_video, rows):
    dst = str(tmp_path / "out")
    for day, text in (("20250101_000000", "old"), ("20250102_000000", "new")):
        data = spark.createDataFrame(
            [("a", text, 1, "t", key, day, 0) for key in ("0123", "a b%é")], COMMENT_ROW
        )
        C.write_comments(data, dst, by_video)
    assert rows(C.read_comments(spark, dst), "video_key", "text") == [
        ("0123", "new"), ("a b%é", "new"),
    ]
    old = C.read_comments(spark, dst, "20250101_000000")
    assert rows(old, "text") == [("old",), ("old",)]
    with pytest.raises(ValueError):
        C.read_comments(spark, dst, "19990101_000000")
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot" in plan
    one = C.read_comments(spark, dst, video="a b%é")
    assert rows(one, "video_key", "text") == [("a b%é", "new")]
    filters = one._jdf.queryExecution().executedPlan().toString()
    assert ("EqualTo(video_key,a b%é)" in filters) != by_video


def test_missing_snapshots_fail_early(spark, tmp_path):
    C.write_comments(spark.createDataFrame([], COMMENT_ROW), str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="no snapshot"):
        C.read_comments(spark, str(tmp_path / "empty"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        C.read_comments(spark, str(tmp_path / "none"))


def test_folder_per_video_layout(spark, tmp_path, rows):
    root = tmp_path / "root"

    def write(snapshot, name, texts, files=1):
        data = [("a", t, 1, "p") for t in texts]
        frame = spark.createDataFrame(data, "author string, text string, like_count int, published_at string")
        frame.repartitionByRange(files, "text").sortWithinPartitions("text").write.parquet(
            str(root / snapshot / name)
        )

    write("20250101_000000", "a b%ü+_1_comments.parquet", ["old"])
    write("20250102_000000", "a b%ü+_1_comments.parquet", list("tuvwxyz"), 3)
    write("20250102_000000", "plain.parquet", ["lost"])
    every = C.read_comment_folders(spark, str(root))
    assert rows(C.key_counts(every)) == [("", 1, False), ("a b%ü+_1", 8, True)]
    got = latest_snapshot(every).where("video_key <> ''")
    ordered = [r[0] for r in got.orderBy("arrival_seq").select("text").collect()]
    assert ordered == list("tuvwxyz")
    assert got.select("arrival_seq").distinct().count() == 7
    assert len(rows(got.select("input_file").distinct())) == 3


def raw_video(video_id, title, channel, **counts):
    return {
        "id": video_id,
        "snippet": {"title": title, "channelTitle": channel, "publishedAt": "2025-01-20T00:00:00Z"},
        "statistics": {k: str(v) for k, v in counts.items()},
    }


def land(folder, name, pages):
    target = folder / name
    target.mkdir(parents=True)
    for i, page in enumerate(pages):
        (target / f"page{i}.json").write_text(json.dumps({"page_seq": i, **page}))
    return str(target)


def test_collection_from_landed_pages(spark, tmp_path, rows):
    search = land(tmp_path, "search", [
        {"items": [{"id": {"videoId": v}} for v in "abc"], "nextPageToken": "x"},
        {"items": [{"id": {"videoId": v}} for v in "cdz"]},
    ])
    details = land(tmp_path, "videos", [
        {"items": [
            raw_video("a", "Kong Official Trailer", " Netflix ", viewCount=5, likeCount=1),
            raw_video("b", "KONG OFFICIAL Trailer 2", "Netflix", viewCount=9, commentCount=4),
            raw_video("c", "Sea Official Trailer", "Nobody", viewCount=50),
        ]},
        {"items": [raw_video("d", "Unrelated", "DC", viewCount=70), {"id": "e"}]},
    ])
    pages = L.readable(L.read_json(spark, search, SEARCH_PAGE))
    videos = L.readable(L.read_json(spark, details, VIDEO_PAGE))
    as_of = F.lit("2025-01-25 00:00:00").cast("timestamp_ntz")
    got = collect_videos(pages, videos, as_of)
    assert rows(got, "video_id", "title", "channel_title", "view_count", "like_count", "comment_count") == [
        ("b", "kong official trailer 2", "Netflix", 9, 0, 4)
    ]
    assert [r["video_id"] for r in collect_videos(pages, videos, as_of, phrases=None).collect()] == ["d", "b"]
    assert rows(L.flatten_videos(videos).where("video_id = 'e'"), "title", "channel_title", "view_count") == [("", "", 0)]
    out = str(tmp_path / "metadata")
    D.write_videos(got, out, "20250125_000000", "last_90_days")
    stored = ("b", "https://www.youtube.com/watch?v=b")
    assert rows(D.read_videos(spark, out), "video_id", "video_url") == [stored]
    D.write_videos(got.limit(0), out, "20250126_000000", "last_90_days")
    D.write_videos(got.withColumn("video_id", F.lit("n")), out, "20250127_000000", "last_90_days")
    assert rows(D.read_videos(spark, out), "video_id") == [("n",)]
    assert rows(D.read_videos(spark, out, "20250125_000000"), "video_id", "video_url") == [stored]


def thread(author, at):
    inner = {"authorDisplayName": author, "textDisplay": "t", "likeCount": 1, "publishedAt": at}
    return {"snippet": {"topLevelComment": {"snippet": inner}}}


def test_comment_collection(spark, tmp_path, rows):
    folder = land(tmp_path, "threads", [
        {"video_id": "a", "status": "ok", "items": [thread("n2", "2025-02"), thread("n1", "2025-01")]},
        {"video_id": "f", "status": "commentsDisabled", "items": None},
        {"video_id": "z", "status": "ok", "items": [thread("q", "2025-02")]},
    ])
    pages = L.readable(L.read_json(spark, folder, THREAD_PAGE))
    videos = spark.createDataFrame(
        [("a", "t"), ("f", "t"), ("", "t")], "video_id string, title string"
    )
    old = spark.createDataFrame(
        [("o", "t", 0, "2025-01", key, "s1", 0) for key in ("a", "f", "gone")], COMMENT_ROW
    )
    merged = collect_comments(old, pages, videos, "s2")
    assert rows(merged, "video_key", "author", "is_new", "snapshot") == [
        ("a", "n2", True, "s2"), ("a", "o", False, "s2"), ("f", "o", False, "s2"),
    ]
    lost = collect_comments(old, pages, videos, "s2", on_missing="drop")
    assert {r[0] for r in rows(lost, "video_key")} == {"a"}


def test_reports(spark, tmp_path):
    comments = spark.createDataFrame(
        [("ü", 0, "gut"), ("b", 0, None)], "video_key string, arrival_seq bigint, text string"
    )
    scorer = S.Lexicon(spark.createDataFrame([("gut", 1)], "term string, polarity int"))
    report = sentiment_report(comments, scorer)
    moment = F.lit("2025-01-25 15:08:35").cast("timestamp_ntz")
    header = W.report_header(report, moment, parameters={"batch_size": 100})
    document = json.loads(W.report_document(report, header, "video_sentiments").first()[0])
    assert document["analysis_timestamp"] == "2025-01-25 15:08:35"
    assert document["total_videos_analyzed"] == 2
    assert document["analysis_parameters"] == {"batch_size": 100}
    assert list(document["video_sentiments"]) == ["b", "ü"]
    one = document["video_sentiments"]["ü"]
    assert one["sentiment_examples"] == {"positive": "gut", "negative": None, "neutral": None}
    assert one["sentiment_stats"]["sentiment_distribution"] == {
        "positive": {"count": 1, "percentage": 100.0}
    }
    lines = {r[0]: json.loads(r[1]) for r in W.report_lines(report).collect()}
    assert lines["ü"] == one
    path = str(tmp_path / "report")
    W.write_report(report, header, path)
    assert spark.read.parquet(f"{path}/table").count() == spark.read.json(f"{path}/videos").count() == 2
    assert spark.read.json(f"{path}/header").first()["total_videos_analyzed"] == 2
    with pytest.raises(ValueError):
        W.report_document(report, header, "video_sentiments", max_videos=1)


def test_stream_reads_each_file_once_and_adds_only_newer(spark, tmp_path, rows):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def land_file(name, comments):
        (folder / name).write_text(json.dumps(comments))

    def run():
        ingest_stream(
            spark, str(folder), target, str(tmp_path / "progress"), "s", pattern=r"([a-z]+)_\d+_comments\.json"
        ).awaitTermination()
        return rows(stored_comments(spark, target), "video_key", "author", "arrival_seq", "batch_id")

    assert stored_comments(spark, target).count() == 0
    land_file("film_1_comments.json", [comment("a", "x", at="2025-01-02"), comment("b", "x", at="2025-01-01")])
    first = run()
    assert first == [("film", "a", 0, 0), ("film", "b", 1, 0)]
    assert run() == first
    land_file("film_2_comments.json", [comment("late", "x", at="2025-01-02"), comment("c", "x", at="2025-01-03")])
    land_file("other_1_comments.json", [comment("d", "x", at="2020-01-01")])
    spark.catalog.clearCache()
    assert run() == [*first, ("film", "c", 2, 1), ("other", "d", 0, 1)]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_batches_of_a_run_do_not_hide_older_files(spark, tmp_path, rows, files_per_batch):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def run(name, at, age, run_name=None):
        (folder / name).write_text(json.dumps([comment(name[5], "x", at=at)]))
        os.utime(folder / name, (1_700_000_000 - age, 1_700_000_000 - age))
        if run_name is not None:
            ingest_stream(
                spark, str(folder), target, str(tmp_path / "progress"), "s", files_per_batch=files_per_batch,
                pattern=r"([a-z]+)_\d+_comments\.json", run=run_name or None,
            ).awaitTermination()
            return sorted(r[0] for r in rows(stored_comments(spark, target), "author"))

    run("film_1_comments.json", "2025-01-03", 9)
    assert run("film_2_comments.json", "2025-01-01", 8, "") == ["1", "2"]
    assert run("film_3_comments.json", "2025-01-02", 7, "") == ["1", "2"]
    run("film_4_comments.json", "2025-01-09", 6, "second")
    assert run("film_5_comments.json", "2025-01-08", 5, "second") == ["1", "2", "4", "5"]
    stored = rows(stored_comments(spark, target), "arrival_seq")
    assert sorted(r[0] for r in stored) == [0, 1, 2, 3]


def test_shared_folder_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark)).rstrip("/")


def test_raw_thread_pages_lose_no_comment(spark):
    thread = lambda video, text: (((("a", text, 1, "2025-01-01T00:00:00Z"),), video),)
    pages = [
        (0, None, None, [thread("v1", "x"), thread("v1", "y")], None),
        (0, "v2", "failed", None, None),
        (0, "v3", None, None, None),
        (0, "v4", "ok", [thread(None, "z")], None),
    ]
    frame = spark.createDataFrame(pages, THREAD_PAGE)
    got = L.flatten_threads(frame).select("video_id", "text").collect()
    assert sorted(map(tuple, got)) == [("v1", "x"), ("v1", "y"), ("v4", "z")]
    assert {r[0] for r in L.failed_videos(frame).collect()} == {"v2", "v3"}


def test_page_numbers_are_unique_without_page_seq(spark, tmp_path):
    thread = lambda text: (((("a", text, 1, "2025-01-01T00:00:00Z"),), "v"),)
    page = (None, None, None, [thread("x"), thread("y")], None)
    other = (None, None, None, [thread("z")], None)
    frame = spark.createDataFrame([page, page, other], THREAD_PAGE)
    got = L.flatten_threads(frame).select("arrival_seq", "text").collect()
    assert len({r[0] for r in got}) == 5 and sorted(r[1] for r in got) == ["x", "x", "y", "y", "z"]
    for i in range(3):
        items = [{"snippet": {"videoId": "v", "topLevelComment": {"snippet": {"textDisplay": f"{i}{j}"}}}} for j in range(2)]
        (tmp_path / f"p{i}.json").write_text(json.dumps({"items": items}))
    read = L.flatten_threads(L.read_pages(spark, str(tmp_path), THREAD_PAGE))
    assert [r[0] for r in read.orderBy("arrival_seq").select("text").collect()] == ["00", "01", "10", "11", "20", "21"]


def test_pages_without_a_field(spark):
    frame = spark.createDataFrame([("v", [((("a", "t"),),)])], "video_id string, items array<struct<snippet:struct<topLevelComment:struct<authorDisplayName:string,textDisplay:string>>>>")
    frame = frame.select("video_id", F.transform("items", lambda i: F.struct(F.struct(F.struct(i["snippet"]["topLevelComment"].alias("snippet")).alias("topLevelComment")).alias("snippet"))).alias("items"))
    got = L.flatten_threads(L.thread_pages(frame)).collect()
    assert [(r["video_id"], r["author"], r["text"], r["like_count"]) for r in got] == [("v", "a", "t", None)]


def test_stream_is_one_snapshot_with_equal_times(spark, tmp_path, rows):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def run(name, comments):
        (folder / name).write_text(json.dumps(comments))
        ingest_stream(
            spark, str(folder), target, str(tmp_path / "progress"), equal_times="compare",
            pattern=r"([a-z]+)_\d+_comments\.json",
        ).awaitTermination()
        got = C.read_comments(spark, target)
        return [(r["author"], r["arrival_seq"]) for r in got.orderBy("arrival_seq").collect()]

    a, b, c, d = (comment(x, "x", at=t) for x, t in (("a", "2025"), ("b", "2025"), ("c", "2025"), ("d", "2026")))
    assert run("film_1_comments.json", [a, a]) == [("a", 0), ("a", 1)]
    assert run("film_2_comments.json", [a, b, a]) == [("a", 0), ("a", 1), ("b", 2)]
    assert run("film_3_comments.json", [b, a, a, a, c]) == [("a", 0), ("a", 1), ("b", 2), ("a", 3), ("c", 4)]
    assert run("film_4_comments.json", [d, c])[5:] == [("d", 5)]
    assert run("film_5_comments.json", [d, c, d])[6:] == [("d", 6)]
