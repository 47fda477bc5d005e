"""Queries over the driver tables, which stand in for videos and comments.

``documents``: source = video, doc_id = arrival. ``conversations``: conversation = video, turn =
arrival. ``events``: user = video, time = publish time. ``part``: brand = publisher, name = title,
price = views, size = likes.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.functions import text as T
from reelgauge.functions import values as N
from reelgauge.operators import entities as E
from reelgauge.operators import leaderboard as B
from reelgauge.operators import tagger as TG
from reelgauge.operators.coherence import topic_coherence as coherence
from reelgauge.operators import merge as M
from reelgauge.operators import ranking as R
from reelgauge.operators import sentiment as S
from reelgauge.operators import snapshots as P
from reelgauge.operators import tokens as K
from reelgauge.operators import topics as G
from reelgauge.operators import video_topics as VT
from reelgauge.operators import videos as V
from reelgauge.plans import reports
from reelgauge.plans.collection import collect_videos
from reelgauge.schemas import THREAD_PAGE, VIDEO_PAGE
from reelgauge.session import scratch_dir, spread, stored
from reelgauge.sources import comments as C
from reelgauge.sources import landing as L
from reelgauge.sources import metadata as D
from reelgauge.sources import parts as PT
from reelgauge.sources.reports import report_header, report_lines
from reelgauge.streaming.ingest import ingest_stream, stored_comments

# Words of the driver's texts, chosen to exercise the operators.
NEGATIVE = [
    "trash", "idiot", "clown", "scum", "worthless", "moron", "pathetic", "loser", "disgusting",
    "stupid",
]
POSITIVE = ["best", "with", "zu"]
GAZETTEER = {
    "License": "DOC", "Licensed": "DOC", "Version": "DOC", "Apache": "ORG", "General": "ORG",
    "Public": "ORG", "Eriner": "PER", "Retion": "LOC", "Réleou": "LOC", "Enmentai": "ORG",
    "Thedre": "PER", "The": "PER", "the": "DET", "THE": "LOUD", "of": "PREP", "que": "CONJ",
    "der": "DET", "Der": "PER", "les": "DET", "trash": "MISC", "idiot": "MISC", "Ofonrereer": "LOC",
}
PHRASES = {
    "The Anea": "ORG", "anea eriner thanea": "PER", "Eriner, thanea": "LOC", "of the": "PREP",
    "the": "DET", "the the the": "RUN", "de la": "PREP", "attion to thanedble the": "LAW",
    "Apache License": "DOC", "General Public License": "DOC", "License": "WORD", "der der": "RUN",
}
PHRASE_POLARITY = {"the the": -1, "the": 1, "of the": 1, "der-der": -1, "der": 1, "de la": 1, "trash": -2, "don't": -1}
BRANDS = ["Brand#2", "Brand#4", "Brand#9", "Brand#12", "Brand#17", "Brand#23"]
PRIORITY_PHRASES = ["urgent", "high", "not spec", "low"]
AS_OF = "2001-08-02 00:00:00"
BLANKS, DIGITS = re.compile(r"[ \t\n\r]+"), re.compile(r"[0-9]+")
PAGE_VIDEO, PAGE, PAGE_BITS = "src1", (20, 30), 6
OLD_END, NEW_START = "2024-01-16", "2024-01-15"
MERGE_CAP, NEWEST_CAP = 25, 40


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def document_comments(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(
        F.col("source").alias("video_key"), F.col("doc_id").alias("arrival_seq"), "text"
    )
    return spread(rows, "arrival_seq")


def conversation_comments(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("video_key"),
        F.col("turn").alias("arrival_seq"),
        F.col("role").alias("author"),
        "text",
    )
    return spread(rows, "video_key", "arrival_seq")


def event_comments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("video_key"),
        F.col("event_id").alias("arrival_seq"),
        F.col("event_type").alias("author"),
        F.col("props").alias("text"),
        F.floor("value").cast("int").alias("like_count"),
        N.iso_time(F.col("ts")).alias("published_at"),
        F.date_format("ts", "yyyyMMdd").alias("snapshot"),
    )


def part_videos(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("video_id"),
        F.col("p_name").alias("title"),
        F.floor("p_retailprice").cast("bigint").alias("view_count"),
        F.col("p_size").cast("bigint").alias("like_count"),
        F.col("p_brand").alias("channel_title"),
        F.col("p_partkey").alias("arrival_seq"),
    )


def lexicon(spark: SparkSession) -> S.Lexicon:
    terms = [(w, -1) for w in NEGATIVE] + [(w, 1) for w in POSITIVE]
    return S.Lexicon(spark.createDataFrame(terms, "term string, polarity int"))


def gazetteer(spark: SparkSession) -> E.Gazetteer:
    terms = spark.createDataFrame(list(GAZETTEER.items()), "term string, type string")
    return E.Gazetteer(terms, case_sensitive=True)


# Sentiment


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    return S.label_sentiment(document_comments(spark, sf), lexicon(spark))


def sentiment_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_documents(spark, sf).select(
        "video_key", "arrival_seq", "sentiment", "confidence"
    )


def sentiment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return S.sentiment_distribution(S.sentiment_counts(labelled_documents(spark, sf)))


def sentiment_totals(spark: SparkSession, sf: str) -> DataFrame:
    return S.sentiment_totals(S.sentiment_counts(labelled_documents(spark, sf)))


def sentiment_summary(spark: SparkSession, sf: str) -> DataFrame:
    share = sentiment_distribution(spark, sf)
    return share.select(
        "video_key",
        "sentiment",
        F.concat(
            N.with_thousands(F.col("count")), F.lit(" ("), N.one_decimal(F.col("percentage")),
            F.lit("%)"),
        ).alias("summary"),
    )


def sentiment_examples(spark: SparkSession, sf: str) -> DataFrame:
    return S.sentiment_examples(labelled_documents(spark, sf))


def sentiment_by_conversation(spark: SparkSession, sf: str) -> DataFrame:
    labelled = S.label_sentiment(conversation_comments(spark, sf), lexicon(spark))
    return S.sentiment_distribution(S.sentiment_counts(labelled))


def sentiment_vs_labels(spark: SparkSession, sf: str) -> DataFrame:
    marks = table(spark, sf, "labels").select(F.col("doc_id").alias("arrival_seq"), "toxic")
    return (
        labelled_documents(spark, sf)
        .join(marks, "arrival_seq")
        .groupBy("sentiment", "toxic")
        .agg(F.count("*").alias("comments"))
    )


def sentiment_trained(spark: SparkSession, sf: str) -> DataFrame:
    """Train on the labelled documents, label all of them."""
    marks = table(spark, sf, "labels").select(F.col("doc_id").alias("arrival_seq"), "toxic", "quality")
    comments = document_comments(spark, sf)
    known = comments.join(marks, "arrival_seq").withColumn(
        "sentiment",
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral"),
    )
    labelled = S.label_sentiment(comments, S.train_sentiment(known))
    return labelled.select("video_key", "arrival_seq", "sentiment", "confidence")


def sentence_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return S.sentence_embeddings(conversation_comments(spark, sf)).select(
        "video_key", "arrival_seq", "embedding"
    )


def sentence_embedding_shape(spark: SparkSession, sf: str) -> DataFrame:
    """What of the vectors does not depend on the model: their length, and which are zero."""
    rows = S.sentence_embeddings(document_comments(spark, sf))
    zero = ~F.exists("embedding", lambda x: x != 0)
    return rows.select("video_key", "arrival_seq", F.size("embedding").alias("width"), zero.alias("is_zero"))


def sentiment_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon with terms of several words."""
    terms = spark.createDataFrame(list(PHRASE_POLARITY.items()), "term string, polarity int")
    labelled = S.label_sentiment(document_comments(spark, sf), S.Lexicon(terms))
    return labelled.select("video_key", "arrival_seq", "sentiment", "confidence")


def sentiment_hook(spark: SparkSession, sf: str) -> DataFrame:
    def load():
        def predict(texts):
            return [
                None if "!" in t else "Positive" if t.count("a") > t.count("e") else "negative"
                for t in texts
            ]

        return predict

    labelled = S.label_sentiment(document_comments(spark, sf), S.Hook(load))
    return labelled.select("video_key", "arrival_seq", "sentiment", "confidence")


def sentiment_vector_hook(spark: SparkSession, sf: str) -> DataFrame:
    def load():
        def predict(matrix):
            return (matrix[:, 0] <= 0).astype("int32") + (matrix[:, :2] <= 0).all(axis=1)

        return predict

    vectors = table(spark, sf, "embeddings")
    width = len(vectors.select("embedding").first()[0])
    rows = vectors.select(
        F.col("label").cast("string").alias("video_key"),
        F.col("vec_id").alias("arrival_seq"),
        F.lit("vector").alias("text"),
        "embedding",
    )
    labelled = S.label_sentiment(rows, S.VectorHook(load, "embedding", width))
    return S.sentiment_distribution(S.sentiment_counts(labelled))


# Videos


def videos_allowlist(spark: SparkSession, sf: str) -> DataFrame:
    return V.allowed_publishers(part_videos(spark, sf), BRANDS)


def videos_movie_key(spark: SparkSession, sf: str) -> DataFrame:
    return V.with_movie_key(part_videos(spark, sf), "ring").select("video_id", "title", "movie_key")


def videos_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return V.one_per_movie(V.with_movie_key(part_videos(spark, sf), "ring"))


def videos_top_n(spark: SparkSession, sf: str) -> DataFrame:
    return V.select_videos(part_videos(spark, sf), BRANDS, 20, "ring")


def order_videos(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.col("o_orderpriority").alias("title"),
        N.iso_time(F.col("o_orderdate")).alias("published_at"),
        F.floor("o_totalprice").cast("bigint").alias("view_count"),
        F.col("o_orderkey").alias("arrival_seq"),
    )


def videos_recent_keyword(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    recent = V.published_within(order_videos(spark, sf), as_of)
    return V.matching_phrases(recent, PRIORITY_PHRASES).select(
        "video_id", "phrase", "published_at", "view_count"
    )


def videos_most_viewed_per_phrase(spark: SparkSession, sf: str) -> DataFrame:
    matches = V.matching_phrases(order_videos(spark, sf), PRIORITY_PHRASES)
    return V.most_viewed_per_phrase(matches, 50).select("phrase", "rank", "video_id", "view_count")


def video_key_sanitise(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("video_id"), F.col("url").alias("title")
    )
    return V.valid_videos(pages).select(
        "video_id",
        T.video_key("title", "video_id").alias("video_key"),
        T.watch_url("video_id").alias("video_url"),
    )


# Landed responses


def flatten_props(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.from_json("props", "k string, missing string")
    return table(spark, sf, "events").withColumn("p", parsed).select(
        "event_id",
        N.count_or_zero(F.col("p.k")).alias("k"),
        N.count_or_zero(F.col("p.missing")).alias("missing"),
        N.text_or_empty(F.col("p.missing")).alias("missing_text"),
        F.to_json(F.struct(F.col("p.k").cast("bigint").alias("k"))).alias("json"),
    )


def video_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Response pages of 50 videos, as they would have landed; counts are text, some missing."""
    statistics = F.struct(
        F.floor("p_retailprice").cast("string").alias("viewCount"),
        F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).alias("likeCount"),
        F.lit(None).cast("string").alias("commentCount"),
    )
    snippet = F.struct(
        F.concat(F.lit("  "), "p_brand", F.lit("\t")).alias("channelTitle"),
        F.upper("p_name").alias("title"),
        F.lit(None).cast("string").alias("publishedAt"),
    )
    item = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        snippet.alias("snippet"),
        statistics.alias("statistics"),
    )
    pages = (
        table(spark, sf, "part")
        .groupBy(F.floor(F.col("p_partkey") / 50).cast("bigint").alias("page_seq"))
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("item")))).alias("i"))
    )
    landed = pages.select(F.to_json(F.struct("page_seq", F.col("i.item").alias("items"))).alias("j"))
    return landed.select(F.from_json("j", VIDEO_PAGE).alias("p")).select("p.*")


def flatten_video_response(spark: SparkSession, sf: str) -> DataFrame:
    return L.flatten_videos(video_pages(spark, sf)).drop("arrival_seq")


def search_then_details(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of a search response, found more than once, then their details."""
    pages = video_pages(spark, sf).select("page_seq", F.posexplode("items").alias("n", "item"))
    hit = F.lower("item.snippet.title")
    ids = pages.where(hit.contains("ring") | hit.contains("hot")).select(
        "page_seq", F.struct(F.struct(F.col("item.id").alias("videoId")).alias("id")).alias("item")
    )
    search = ids.groupBy("page_seq").agg(F.collect_list("item").alias("items"))
    found = L.flatten_search(search.unionByName(search))
    return L.searched_videos(found, L.flatten_videos(video_pages(spark, sf))).select(
        "video_id", "title", "channel_title", "view_count", "like_count"
    )


def thread_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Comment-thread pages of up to 5 comments. Pages of even conversations name their video only
    in the comments, as the service does; one-comment pages stand for failed fetches."""
    comment = F.struct(
        F.col("role").alias("authorDisplayName"),
        F.col("text").alias("textDisplay"),
        F.length("text").alias("likeCount"),
        F.lpad(F.col("turn").cast("string"), 6, "0").alias("publishedAt"),
    )
    nested = F.struct(
        F.struct(
            F.struct(comment.alias("snippet")).alias("topLevelComment"),
            F.col("conv_id").cast("string").alias("videoId"),
        ).alias("snippet")
    )
    return (
        table(spark, sf, "conversations")
        .groupBy("conv_id", F.floor(F.col("turn") / 5).cast("bigint").alias("page_seq"))
        .agg(
            F.array_sort(F.collect_list(F.struct("turn", nested.alias("item")))).alias("i"),
            F.when(F.count("*") > 1, "ok").otherwise("videoNotFound").alias("status"),
        )
        .select(
            F.when((F.col("conv_id") % 2 == 1) | (F.col("status") != "ok"), F.col("conv_id").cast("string")).alias("video_id"),
            "page_seq",
            "status",
            F.col("i.item").alias("items"),
        )
    )


def flatten_thread_response(spark: SparkSession, sf: str) -> DataFrame:
    return L.flatten_threads(L.thread_pages(thread_pages(spark, sf))).drop("arrival_seq")


def raw_thread_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as the service returns them, without number, status or video, written as JSON and read
    back: the comments of each video by arrival number."""
    pages = thread_pages(spark, sf).where("status = 'ok'")
    folder = scratch_dir(spark, "raw-threads")
    ordered = pages.repartitionByRange(4, F.col("items")[0]["snippet"]["videoId"], "page_seq")
    named = ordered.sortWithinPartitions(F.col("items")[0]["snippet"]["videoId"], "page_seq")
    named.select("items").write.json(folder)
    rows = L.flatten_threads(stored(L.read_pages(spark, folder, THREAD_PAGE, multiline=False), "pages"))
    return R.with_row_index(rows, "video_id", "arrival_seq").select(
        "video_id", "row_index", "author", "text", "published_at"
    )


def failed_fetches(spark: SparkSession, sf: str) -> DataFrame:
    return L.failed_videos(thread_pages(spark, sf))


# Incremental merge and snapshots


def previous_comments(spark: SparkSession, sf: str) -> DataFrame:
    return event_comments(spark, sf).where(F.col("published_at") < OLD_END)


def new_comments(spark: SparkSession, sf: str) -> DataFrame:
    return event_comments(spark, sf).where(F.col("published_at") >= NEW_START)


def listed_videos(spark: SparkSession, sf: str) -> DataFrame:
    return event_comments(spark, sf).where(F.col("like_count") >= 200).select("video_key")


def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return M.high_water_marks(previous_comments(spark, sf))


MERGED = ["video_key", "arrival_seq", "author", "published_at", "like_count"]


def incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    merged = M.merge_comments(
        previous_comments(spark, sf), new_comments(spark, sf), cap=MERGE_CAP
    )
    return merged.select(*MERGED, "is_new")


def merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.merge_counts(incremental_merge(spark, sf))


def merge_current_only(spark: SparkSession, sf: str) -> DataFrame:
    merged = M.merge_comments(
        previous_comments(spark, sf), new_comments(spark, sf), listed_videos(spark, sf)
    )
    return merged.select(*MERGED, "is_new")


def merge_dropped(spark: SparkSession, sf: str) -> DataFrame:
    return M.of_unlisted_videos(previous_comments(spark, sf), listed_videos(spark, sf)).select(*MERGED)


def merge_failed_dropped(spark: SparkSession, sf: str) -> DataFrame:
    failed = listed_videos(spark, sf).distinct()
    merged = M.merge_comments(
        previous_comments(spark, sf), new_comments(spark, sf), failed=failed, on_missing="drop"
    )
    return merged.select(*MERGED, "is_new")


def newest_cap(spark: SparkSession, sf: str) -> DataFrame:
    return R.newest_per_key(event_comments(spark, sf), NEWEST_CAP).select(*MERGED)


def newest_comments(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of all comments, newest first."""
    return R.newest_first(event_comments(spark, sf)).limit(100).select(*MERGED)


def row_index(spark: SparkSession, sf: str) -> DataFrame:
    return R.with_row_index(
        event_comments(spark, sf).select("video_key", "arrival_seq")
    )


def index_page_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A page of a stored video, found by its stored block index."""
    folder, video = scratch_dir(spark, "paged"), PAGE_VIDEO
    rows = document_comments(spark, sf).select(
        F.lit(None).cast("string").alias("author"), "text", F.length("text").alias("like_count"),
        F.lit("").alias("published_at"), "video_key", F.lit("20240201_000000").alias("snapshot"), "arrival_seq",
    )
    C.write_comments(rows, f"{folder}/comments")
    kept_rows = C.read_comments(spark, f"{folder}/comments")
    index = stored(R.block_index(kept_rows, block_bits=PAGE_BITS), "block-index")
    page = R.indexed_page(kept_rows, index, video, *PAGE, block_bits=PAGE_BITS)
    return page.select("video_key", "row_index", "arrival_seq", "like_count")


def comment_folders(spark: SparkSession, sf: str) -> DataFrame:
    """One Parquet folder for each video, as the old layout has them, read as one table."""
    folder = scratch_dir(spark, "folders")
    rows = conversation_comments(spark, sf).select(
        F.lit("a").alias("author"), "text", F.length("text").alias("like_count"), F.lit("2024").alias("published_at"),
        F.concat(F.pmod(F.col("video_key").cast("bigint"), F.lit(16)).cast("string"), F.lit("_comments.parquet")).alias("f"),
    )
    rows.write.partitionBy("f").parquet(f"{folder}/20240201_000000")
    read = C.read_comment_folders(spark, folder, r"f=([^/]+)_comments\.parquet")
    return read.groupBy("video_key").agg(
        F.count("*").alias("total_comments"), F.countDistinct("arrival_seq").alias("numbers"),
        F.sum("like_count").alias("likes"),
    )


def video_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Selected videos written by two runs and read back: the latest run's."""
    folder = scratch_dir(spark, "metadata")
    videos = part_videos(spark, sf).withColumns(
        {"published_at": F.lit("2024-01-01T00:00:00Z"), "comment_count": F.lit(0).cast("bigint"), "video_url": T.watch_url("video_id")}
    )
    D.write_videos(videos, folder, "20240101_000000", "last_90_days")
    D.write_videos(videos.where("like_count >= 25"), folder, "20240201_000000", "last_90_days")
    return D.read_videos(spark, folder).select("video_id", "title", "view_count", "like_count", "video_url", "channel_title")


def collected_videos(spark: SparkSession, sf: str) -> DataFrame:
    """From search and detail pages to the selected videos of the period."""
    pages = video_pages(spark, sf)
    found = pages.select("page_seq", F.expr("transform(items, i -> named_struct('id', named_struct('videoId', i.id)))").alias("items"))
    day = F.when(F.col("item.id").cast("bigint") % 4 == 0, "2023-01-01").otherwise("2024-01-01")
    dated = pages.select("page_seq", F.posexplode("items").alias("n", "item")).withColumn(
        "item", F.col("item").withField("snippet.publishedAt", F.concat(day, F.lit("T00:00:00Z")))
    )
    details = dated.groupBy("page_seq").agg(F.array_sort(F.collect_list(F.struct("n", "item"))).alias("i"))
    details = details.select("page_seq", F.col("i.item").alias("items"))
    chosen = collect_videos(
        found, details, F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00")), 90, 20, allowed=BRANDS, phrases=["ring", "hot"]
    )
    return chosen.select("video_id", "title", "channel_title", "view_count")


def report_totals(spark: SparkSession, sf: str) -> DataFrame:
    """The head of a report: its time, its number of videos, its parameters."""
    counts = S.sentiment_counts(labelled_documents(spark, sf))
    head = report_header(counts, F.lit("2024-02-01 10:00:00").cast("timestamp_ntz"), parameters={"batch_size": 100})
    return head.select("analysis_timestamp", "total_videos_analyzed", F.col("analysis_parameters.batch_size").alias("batch_size"))


def empty_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Comments with text, where short ones are NULL, empty or blank."""
    short = F.when(F.length("text") % 3 == 0, F.lit(None).cast("string")).when(F.length("text") % 3 == 1, F.lit("")).otherwise(F.lit("  "))
    rows = document_comments(spark, sf).withColumn("text", F.when(F.length("text") < 400, short).otherwise(F.col("text")))
    return rows.where(T.has_text("text")).groupBy("video_key").agg(F.count("*").alias("with_text"), F.count_if(F.col("text") == "  ").alias("blank"))


def row_index_page(spark: SparkSession, sf: str) -> DataFrame:
    return R.index_page(row_index(spark, sf), 10, 20)


def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return P.latest_snapshot(event_comments(spark, sf)).select("snapshot", *MERGED)


def pinned_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return P.pinned_snapshot(event_comments(spark, sf), "20240108").select("snapshot", *MERGED)


def keep_latest(spark: SparkSession, sf: str) -> DataFrame:
    return P.keep_latest(event_comments(spark, sf), 3).select("snapshot", *MERGED)


def single_video(spark: SparkSession, sf: str) -> DataFrame:
    videos = table(spark, sf, "documents").withColumnRenamed("source", "video_key")
    return C.of_video(videos, "src7").select("video_key", "doc_id", "lang", "n_chars")


# Tokens and vocabularies


def clean_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return K.with_tokens(document_comments(spark, sf)).select(
        "video_key",
        "arrival_seq",
        F.size("tokens").cast("bigint").alias("tokens"),
        F.array_join("tokens", " ").alias("joined"),
    )


def shrunk_text(spark: SparkSession, sf: str) -> DataFrame:
    return document_comments(spark, sf).select("arrival_seq", T.shrink("text").alias("text"))


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return K.vocabulary(K.with_tokens(document_comments(spark, sf)))


def vocabulary_by_video(spark: SparkSession, sf: str) -> DataFrame:
    return K.vocabulary(K.with_tokens(document_comments(spark, sf)), "video_key")


def vocabulary_size(spark: SparkSession, sf: str) -> DataFrame:
    return K.vocabulary_size(vocabulary_by_video(spark, sf), "video_key")


# Entities


def entity_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return E.tag_entities(document_comments(spark, sf), E.Patterns())


def entity_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    return E.tag_entities(document_comments(spark, sf), gazetteer(spark))


def bio_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Tags built by expression; the tag array is one short of the tokens, and empty where there are none."""
    tag = lambda t: (
        F.when(t.rlike(r"[0-9]"), F.lit("NUM"))
        .when(t.rlike(r"^\p{Lu}"), F.lit("B-CAP"))
        .when(t.endswith("."), F.lit("I-END-STOP"))
        .otherwise(F.lit("O"))
    )
    tagged = document_comments(spark, sf).withColumn("token", T.raw_tokens("text"))
    short = F.slice("token", F.lit(1), F.greatest(F.size("token") - 1, F.lit(0)))
    return E.entity_mentions(tagged.withColumn("ner", F.transform(short, tag)))


def gazetteer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return E.entity_counts(entity_gazetteer(spark, sf))


def entity_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return gazetteer_counts(spark, sf).select("video_key", "text", "type", "count")


def entity_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Names of several words: the longest term at each place, every token of it a mention."""
    terms = spark.createDataFrame(list(PHRASES.items()), "term string, type string")
    return E.tag_entities(document_comments(spark, sf), E.PhraseGazetteer(terms))


def entity_trained(spark: SparkSession, sf: str) -> DataFrame:
    """A tagger trained on the labelled documents, tagged by the dictionary, over all documents."""
    terms = spark.createDataFrame(list(PHRASES.items()), "term string, type string")
    comments = document_comments(spark, sf)
    known = comments.join(table(spark, sf, "labels").select(F.col("doc_id").alias("arrival_seq")).distinct(), "arrival_seq", "left_semi")
    tagger = TG.train_tagger(E.PhraseGazetteer(terms).tag(known, "text"))
    return E.tag_entities(comments, tagger)


def top_entities(spark: SparkSession, sf: str) -> DataFrame:
    return E.top_entities(gazetteer_counts(spark, sf))


def entities_by_type(spark: SparkSession, sf: str) -> DataFrame:
    grouped = E.entities_by_type(top_entities(spark, sf))
    return grouped.select("video_key", F.explode("entities_by_type").alias("type", "items")).select(
        "video_key", "type", F.posexplode("items").alias("place", "e")
    ).select("video_key", "type", "place", "e.text", "e.count")


def entity_totals(spark: SparkSession, sf: str) -> DataFrame:
    counts = E.entity_counts(entity_pattern(spark, sf))
    return E.entity_totals(document_comments(spark, sf), counts)


def entity_hook(spark: SparkSession, sf: str) -> DataFrame:
    def load():
        def annotate(texts):
            pairs = [BLANKS.split(t) for t in texts]  # tokens of the whole text, any script
            return [(p, ["B-NUM" if DIGITS.fullmatch(w) else "O" for w in p]) for p in pairs]

        return annotate

    return E.tag_entities(document_comments(spark, sf), E.Hook(load))


# Topics


def _token_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.with_tokens(document_comments(spark, sf), lower=True)
    return stored(rows.select("video_key", "arrival_seq", "tokens"), "tokens")


def _mixed_token_rows(spark: SparkSession, sf: str) -> DataFrame:
    return K.with_tokens(document_comments(spark, sf)).select("video_key", "arrival_seq", "tokens")


def topics_by_key(spark: SparkSession, sf: str) -> DataFrame:
    model = VT.fit_video_topics(_token_rows(spark, sf))
    topics = G.topic_summary(model.topics())
    return topics.join(model.metrics(), "video_key").select(
        "video_key", "topic", F.array_join("words", " ").alias("words"), "summary",
        "vocabulary_size", "steps", "log_likelihood", "log_perplexity",
    )


def topics_global(spark: SparkSession, sf: str) -> DataFrame:
    return G.topic_mixture(G.fit_topics(_token_rows(spark, sf)))


def topic_words(spark: SparkSession, sf: str) -> DataFrame:
    model = G.fit_topics(_token_rows(spark, sf))
    return G.topic_summary(G.topic_words(model)).select(
        "topic", F.array_join("words", " ").alias("words"), "summary"
    )


def topic_coherence(spark: SparkSession, sf: str) -> DataFrame:
    """Coherence of two word lists of each video, its most frequent terms and the next."""
    rows = stored(_mixed_token_rows(spark, sf), "tokens")
    vocab = stored(K.vocabulary(rows, "video_key").where("rank <= 10"), "vocabulary")
    topic = F.floor((F.col("rank") - 1) / 5).cast("int")
    topics = vocab.groupBy("video_key", topic.alias("topic")).agg(F.collect_list("term").alias("words"))
    return coherence(rows, topics).withColumn("coherence", F.round("coherence", 6))


def topics_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as videos: most are too short for a term in five comments."""
    comments = conversation_comments(spark, sf)
    rows = K.with_tokens(comments).select("video_key", "arrival_seq", "tokens")
    return K.skipped_videos(comments, rows, K.vocabulary(rows, "video_key"))


# Leaderboard and reports


def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    counts = S.sentiment_counts(labelled_documents(spark, sf))
    videos = part_videos(spark, sf).withColumn("video_key", F.concat(F.lit("src"), "video_id"))
    return B.leaderboard(videos, S.dominant_sentiment(counts))


def leaderboard_search(spark: SparkSession, sf: str) -> DataFrame:
    return B.search_titles(part_videos(spark, sf), "Hot R").select("video_id", "title", "like_count")


def report_json(spark: SparkSession, sf: str) -> DataFrame:
    return report_lines(reports.sentiment_report(document_comments(spark, sf), lexicon(spark)))


def entity_report_json(spark: SparkSession, sf: str) -> DataFrame:
    return report_lines(reports.entity_report(document_comments(spark, sf), gazetteer(spark)))


def topic_report_json(spark: SparkSession, sf: str) -> DataFrame:
    comments = document_comments(spark, sf)
    model = VT.fit_video_topics(_token_rows(spark, sf))
    return report_lines(reports.topic_report(comments, model.topics(), model.metrics()))


def video_totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").agg(
        F.count("*").alias("total_comments"), F.countDistinct("source").alias("total_videos")
    )


def time_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        N.run_id(F.col("ts")).alias("run_id"),
        N.report_time(F.col("ts")).alias("report_time"),
        N.days_before(F.col("ts"), 90).alias("since"),
    )


# Files and streams


def _landed_events(spark: SparkSession, sf: str, folder: str, condition: Column | None = None) -> str:
    rows = event_comments(spark, sf)
    if condition is not None:
        rows = rows.where(condition)
    # One folder per day, so that the number of files does not grow with the number of videos;
    # the key pattern reads the day as the video.
    day = F.concat("snapshot", F.lit("_comments.json"))
    rows = rows.select("author", "text", "like_count", "published_at", day.alias("d"))
    rows.write.partitionBy("d").mode("append").json(folder)
    return folder


DAY_PATTERN = r"d=([^/]+)_comments\.json"


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "roundtrip")
    src = _landed_events(spark, sf, f"{folder}/landing")
    C.json_to_parquet(
        spark, src, f"{folder}/comments", "20240201_000000", multiline=False, pattern=DAY_PATTERN
    )
    return C.read_comments(spark, f"{folder}/comments").drop("arrival_seq")


def _hourly(rows: DataFrame) -> DataFrame:
    """Publish times by the hour, so that many comments share the time of a mark."""
    return rows.withColumn("published_at", F.concat(F.substring("published_at", 1, 13), F.lit(":00:00Z")))


def merge_at_mark(spark: SparkSession, sf: str) -> DataFrame:
    """A fetch that stopped in the middle of an hour, then one that brings the whole hours again,
    twice: comments at the time of the mark are neither lost nor doubled."""
    rows = _hourly(event_comments(spark, sf))
    old = rows.where((F.col("published_at") < OLD_END) & ((F.col("arrival_seq") % 5 != 0) | (F.col("published_at") < NEW_START)))
    new = rows.where(F.col("published_at") >= NEW_START)
    once = stored(M.merge_comments(old, new, equal_times="compare").drop("is_new"), "merged")
    twice = M.merge_comments(once, new, equal_times="compare")
    return twice.select(*MERGED, "is_new")


def snapshot_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs that write additions only, the second without some videos: the latest snapshot."""
    root = scratch_dir(spark, "parts")
    rows = event_comments(spark, sf)
    steps = [("20240101_000000", F.col("published_at") < NEW_START), ("20240102_000000", F.col("published_at").between(NEW_START, OLD_END)), ("20240103_000000", F.col("published_at") > OLD_END)]
    for i, (run, condition) in enumerate(steps):
        gone = listed_videos(spark, sf) if i == 1 else None
        PT.add_snapshot(spark, root, run, rows.where(condition), gone, compact_share=2.0 if i < 2 else 0.2)
    return PT.read_snapshot(spark, root).select("snapshot", *MERGED)


def ingest_then_read(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the stream with ids of their own, the first file landed again, read as one
    snapshot."""
    folder = scratch_dir(spark, "ingest")
    day = F.col("snapshot")
    for i, condition in enumerate((day < "20240116", day >= "20240116")):
        landing = _landed_events(spark, sf, f"{folder}/landing", condition)
        if i:
            _landed_events(spark, sf, f"{folder}/landing", day == "20240115")
        ingest_stream(
            spark, landing, f"{folder}/comments", f"{folder}/progress", multiline=False,
            pattern=DAY_PATTERN, run=f"run-{i}", equal_times="compare",
        ).awaitTermination()
    return C.read_comments(spark, f"{folder}/comments").drop("arrival_seq")


def ingest_in_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the stream over a landing folder that grew in between."""
    folder = scratch_dir(spark, "ingest")
    day = F.col("snapshot")
    for condition in (day < "20240116", day >= "20240116"):
        landing = _landed_events(spark, sf, f"{folder}/landing", condition)
        ingest_stream(
            spark, landing, f"{folder}/comments", f"{folder}/progress", "20240201_000000",
            multiline=False, pattern=DAY_PATTERN,
        ).awaitTermination()
    return stored_comments(spark, f"{folder}/comments").drop("arrival_seq")


CATALOG: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        sentiment_labels, sentiment_distribution, sentiment_totals, sentiment_summary,
        sentiment_examples, sentiment_by_conversation, sentiment_vs_labels, sentiment_trained,
        sentence_embeddings, sentence_embedding_shape, sentiment_hook, sentiment_vector_hook, sentiment_phrases,
        videos_allowlist, videos_movie_key, videos_dedupe, videos_top_n, videos_recent_keyword,
        videos_most_viewed_per_phrase, video_key_sanitise,
        flatten_props, flatten_video_response, search_then_details, flatten_thread_response,
        raw_thread_pages,
        failed_fetches,
        high_water_mark, incremental_merge, merge_counts, merge_current_only, merge_dropped,
        merge_failed_dropped, merge_at_mark, newest_cap, newest_comments, row_index, row_index_page, index_page_lookup,
        comment_folders, video_metadata, collected_videos, report_totals, empty_texts, latest_snapshot,
        pinned_snapshot, keep_latest,
        clean_tokens, shrunk_text, vocabulary, vocabulary_by_video, vocabulary_size,
        entity_pattern, entity_gazetteer, entity_phrases, entity_trained, bio_flatten, entity_frequency, top_entities,
        entities_by_type, entity_totals, entity_hook,
        topics_by_key, topics_global, topic_words, topic_coherence, topics_skipped, single_video,
        leaderboard, leaderboard_search, report_json, entity_report_json, topic_report_json,
        video_totals, time_labels, json_roundtrip, ingest_in_two_runs, ingest_then_read, snapshot_parts,
    ]
}
