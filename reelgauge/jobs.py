"""Batch jobs, for spark-submit:

    jobs.py select    --search DIR --videos DIR --out DIR --run-id 20260301_120000
    jobs.py merge     --threads DIR --selected DIR --comments DIR --run-id ID [--previous ID]
    jobs.py convert   --landing DIR --comments DIR --run-id ID
    jobs.py ingest    --landing DIR --comments DIR --progress DIR --run-id ID
    jobs.py retain    --comments DIR --run-id ID [--keep N]
    jobs.py sentiment --comments DIR --out DIR --run-id ID [--lexicon PARQUET]
    jobs.py entities  --comments DIR --out DIR --run-id ID [--gazetteer PARQUET | --model DIR]
    jobs.py topics    --comments DIR --out DIR --run-id ID
    jobs.py board     --selected DIR --comments DIR --out DIR --run-id ID [--query TEXT]

The run id is a time, and names the snapshot or report that the job writes. The analysing jobs take
the latest snapshot unless --snapshot names one; --folders reads one Parquet dataset per video.
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.functions import starter
from reelgauge.functions.fixed import PERIOD_DAYS, TOP_VIDEOS
from reelgauge.operators import entities as E
from reelgauge.operators import leaderboard as B
from reelgauge.operators import sentiment as S
from reelgauge.operators import tagger as TG
from reelgauge.operators.joins import release_after
from reelgauge.operators.snapshots import latest_snapshot, pinned_snapshot
from reelgauge.operators.tokens import with_tokens
from reelgauge.operators.video_topics import fit_video_topics
from reelgauge.plans import reports
from reelgauge.plans.collection import collect_comments, collect_videos
from reelgauge.schemas import COMMENT_ROW, SEARCH_PAGE, THREAD_PAGE, VIDEO_PAGE
from reelgauge.session import get_session, stored
from reelgauge.sources import comments as C
from reelgauge.sources import landing as L
from reelgauge.sources import metadata as D
from reelgauge.sources import reports as W
from reelgauge.streaming.ingest import ingest_stream


def run_time(run_id: str) -> Column:
    return F.to_timestamp_ntz(F.lit(run_id), F.lit("yyyyMMdd_HHmmss"))


def lexicon(spark: SparkSession, path: str | None) -> S.Lexicon:
    if path:
        return S.Lexicon(spark.read.parquet(path))
    terms = [(w, 1) for w in starter.POSITIVE] + [(w, -1) for w in starter.NEGATIVE]
    return S.Lexicon(spark.createDataFrame(terms, "term string, polarity int"))


def comments_of(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """One snapshot, the latest by default, of the partitioned table or of per-video folders."""
    if not a.folders:
        return C.read_comments(spark, a.comments, a.snapshot)
    rows = C.read_comment_folders(spark, a.comments, C.ID_IN_PARQUET).where("video_key <> ''")
    return pinned_snapshot(rows, a.snapshot) if a.snapshot else latest_snapshot(rows)


def pages(spark: SparkSession, path: str, schema) -> DataFrame:
    """Landed pages, parsed once."""
    return stored(L.read_pages(spark, path, schema), "pages")


def select(spark: SparkSession, a: argparse.Namespace) -> None:
    chosen = collect_videos(
        pages(spark, a.search, SEARCH_PAGE), pages(spark, a.videos, VIDEO_PAGE),
        run_time(a.run_id), a.days, a.top,
    )
    D.write_videos(chosen, a.out, a.run_id, f"last_{a.days}_days")


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.fresh:
        previous = spark.createDataFrame([], COMMENT_ROW)
    elif a.previous:
        previous = C.read_comments(spark, a.comments, a.previous)
    else:
        previous = C.earlier_comments(spark, a.comments, a.run_id)
    videos = D.read_videos(spark, a.selected)
    threads = pages(spark, a.threads, THREAD_PAGE)
    merged = collect_comments(previous, threads, videos, a.run_id, equal_times="compare")
    C.write_comments(merged, a.comments)


def convert(spark: SparkSession, a: argparse.Namespace) -> None:
    C.json_to_parquet(
        spark, a.landing, a.comments, a.run_id, rejects=f"{a.comments}_rejects/{a.run_id}",
        pattern=C.ID_IN_JSON,
    )


def ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    ingest_stream(
        spark, a.landing, a.comments, a.progress, run=a.run_id, equal_times="compare",
        pattern=C.ID_IN_JSON,
    ).awaitTermination()


def retain(spark: SparkSession, a: argparse.Namespace) -> None:
    C.drop_older(spark, a.comments, a.keep)


def _write(report: DataFrame, a: argparse.Namespace, kind: str, **header) -> None:
    head = W.report_header(report, run_time(a.run_id), **header)
    W.write_report(report, head, f"{a.out}/{kind}_analysis_{a.run_id}")


def sentiment(spark: SparkSession, a: argparse.Namespace) -> None:
    comments = comments_of(spark, a)
    _write(reports.sentiment_report(comments, lexicon(spark, a.lexicon)), a, "sentiment")


def entities(spark: SparkSession, a: argparse.Namespace) -> None:
    comments = comments_of(spark, a)
    if a.model:
        tagger = TG.load_tagger(spark, a.model)
    elif a.gazetteer:
        tagger = E.PhraseGazetteer(spark.read.parquet(a.gazetteer))
    else:
        tagger = E.Patterns()
    report = reports.entity_report(comments, tagger, a.top)
    _write(report, a, "entity", counted_as="total_movies_analyzed", parameters={"top": a.top})


def topics(spark: SparkSession, a: argparse.Namespace) -> None:
    comments = comments_of(spark, a)
    tokens = with_tokens(comments).select("video_key", "arrival_seq", "tokens")
    rows = stored(tokens, "tokens")
    model = fit_video_topics(rows, seed=a.seed)
    _write(reports.topic_report(comments, model.topics(), model.metrics()), a, "topic")
    left = model.skipped(comments, rows)
    left.write.mode("overwrite").options(**W.JSON_OPTIONS).json(f"{a.out}/topic_skipped_{a.run_id}")


def board(spark: SparkSession, a: argparse.Namespace) -> None:
    labelled = S.label_sentiment(comments_of(spark, a), lexicon(spark, a.lexicon))
    videos = D.read_videos(spark, a.selected)
    rows = B.leaderboard(
        videos.withColumn("video_key", F.col("video_id")),
        S.dominant_sentiment(S.sentiment_counts(labelled)), a.query,
    )
    rows.write.mode("overwrite").options(**W.JSON_OPTIONS).json(f"{a.out}/leaderboard_{a.run_id}")


JOBS = {
    "select": (select, ["search", "videos", "out"]),
    "merge": (merge, ["threads", "selected", "comments"]),
    "convert": (convert, ["landing", "comments"]),
    "ingest": (ingest, ["landing", "comments", "progress"]),
    "retain": (retain, ["comments"]),
    "sentiment": (sentiment, ["comments", "out"]),
    "entities": (entities, ["comments", "out"]),
    "topics": (topics, ["comments", "out"]),
    "board": (board, ["selected", "comments", "out"]),
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="reelgauge")
    kinds = parser.add_subparsers(dest="job", required=True)
    for name, (_, folders) in JOBS.items():
        job = kinds.add_parser(name)
        for folder in folders:
            job.add_argument(f"--{folder}", required=True)
        job.add_argument("--run-id", required=True)
        if name == "select":
            job.add_argument("--days", type=int, default=PERIOD_DAYS)
            job.add_argument("--top", type=int, default=TOP_VIDEOS)
        elif name == "retain":
            job.add_argument("--keep", type=int, default=1)
        elif name == "merge":
            job.add_argument("--previous")
            job.add_argument("--fresh", action="store_true")
        elif name in ("sentiment", "entities", "topics", "board"):
            job.add_argument("--snapshot")
            job.add_argument("--folders", action="store_true")
            job.add_argument("--lexicon")
            job.add_argument("--gazetteer")
            job.add_argument("--model")
            job.add_argument("--query")
            job.add_argument("--top", type=int, default=10)
            job.add_argument("--seed", type=int, default=7)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    with release_after():
        JOBS[options.job][0](get_session(f"reelgauge {options.job}"), options)


if __name__ == "__main__":
    main()
