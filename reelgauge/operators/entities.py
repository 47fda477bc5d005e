"""Named-entity tags, mentions and rankings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.functions import text as T
from reelgauge.functions.fixed import TOP_ENTITIES
from reelgauge.operators.joins import BROADCAST_BYTES, join_lookup
from reelgauge.operators.phrases import longest_matches
from reelgauge.session import give_back

KEY, SEQ = "video_key", "arrival_seq"
#: Bytes of text that a user model gets at once.
TEXT_BYTES = 1 << 20

# Typed patterns; alternatives must not use capture groups or anchors.
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "IP": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\b",
    "PHONE": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){2,3}\b",
}


def entity_mentions(tagged: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Flatten parallel ``token``/``ner`` arrays to one row per tagged token.

    Each token counts alone; a missing or ``O`` tag is no mention.
    """
    pairs = F.arrays_zip(F.col("token"), F.col("ner"))
    flat = tagged.select(key, seq, F.posexplode(pairs).alias("pos", "pair"))
    return flat.where(F.col("pair.ner") != "O").select(
        key,
        seq,
        F.col("pos").cast("bigint").alias("pos"),
        F.lower("pair.token").alias("text"),
        T.tag_type(F.col("pair.ner")).alias("type"),
    )


class Gazetteer:
    """Dictionary of ``term, type``; a token is matched as written, or lower-cased. A term with
    several types takes the first by name, so that a token is one mention."""

    def __init__(self, terms: DataFrame, case_sensitive: bool = False):
        name = F.col("term") if case_sensitive else F.lower("term")
        self.terms = terms.groupBy(name.alias("_name")).agg(F.min("type").alias("type"))
        self.case_sensitive = case_sensitive

    def mentions(self, df: DataFrame, text: str) -> DataFrame:
        tokens = name_tokens(text)
        flat = df.where(T.has_text(text)).select(
            KEY, SEQ, F.posexplode(tokens).alias("pos", "token")
        )
        name = F.col("token") if self.case_sensitive else F.lower("token")
        return join_lookup(flat.withColumn("_name", name), self.terms, "_name").select(
            KEY,
            SEQ,
            F.col("pos").cast("bigint").alias("pos"),
            F.lower("token").alias("text"),
            "type",
        )


def name_tokens(value: Column | str) -> Column:
    """Runs of letters and digits, as the dictionaries see a text."""
    text = F.col(value) if isinstance(value, str) else value
    return F.array_remove(F.split(F.regexp_replace(text, r"(?U)[^\p{L}\p{N}]+", " "), " "), "")


class PhraseGazetteer:
    """Dictionary of ``term, type`` whose terms may have several tokens. The longest term counts
    where terms overlap, from left to right, and every token of it is a mention of the type. A term
    with several types takes the first by name; terms without a letter or digit are left out."""

    def __init__(self, terms: DataFrame, case_sensitive: bool = False, limit_bytes: int = BROADCAST_BYTES):
        name = F.col("term") if case_sensitive else F.lower("term")
        self.case_sensitive, self.limit_bytes = case_sensitive, limit_bytes
        words = terms.where("term is not null").select(name_tokens(name).alias("words"), "type")
        self.terms = words.where(F.size("words") > 0).groupBy("words").agg(F.min("type").alias("type"))

    def _matched(self, df: DataFrame, text: str) -> tuple[DataFrame, Column]:
        """Rows with ``tokens`` and ``matches``, and the types by number."""
        types = sorted(r[0] for r in self.terms.select("type").distinct().collect() if r[0] is not None)
        numbered = F.array(*[F.lit(x) for x in types]).cast("array<string>")
        terms = self.terms.where("type is not null").select("words", (F.array_position(numbered, F.col("type")) - 1).cast("int").alias("value"))
        source = F.col(text) if self.case_sensitive else F.lower(text)
        rows = df.where(T.has_text(text)).withColumn("tokens", F.explode(F.array(name_tokens(source))))
        return longest_matches(rows, terms, [KEY, SEQ], self.limit_bytes), numbered

    def tag(self, df: DataFrame, text: str) -> DataFrame:
        """Rows with text, with ``token`` and BIO ``ner`` arrays: what a tagger is trained on where
        nothing is tagged by hand."""
        found, types = self._matched(df, text)
        before = F.expr("transform(matches, (m, i) -> m.start - if(i = 0, 0, matches[i - 1].start + matches[i - 1].size))")
        end = F.expr("if(size(matches) = 0, 0, matches[size(matches) - 1].start + matches[size(matches) - 1].size)")
        types_of = F.transform("matches", lambda m: F.get(types, m["value"]))
        # Generators, so that no array is computed again for each element of another.
        once = F.inline(F.array(F.struct(before.alias("_gaps"), types_of.alias("_types"), (F.size("tokens") - end).alias("_left"))))
        gaps = found.select("*", once)
        parts = F.expr("transform(matches, (m, i) -> concat(array_repeat('O', _gaps[i]), array('B-' || _types[i]), array_repeat('I-' || _types[i], m.size - 1)))")
        ner = F.concat(F.flatten(parts), F.expr("array_repeat('O', _left)"))
        written = F.inline(F.array(F.struct(name_tokens(text).alias("_written"), ner.alias("ner"))))
        # Lower-casing can split a token of a rare letter; the tokens that were matched then stay.
        tokens = F.when(F.size("_written") == F.size("tokens"), F.col("_written")).otherwise(F.col("tokens"))
        return gaps.select("*", written).select(*df.columns, tokens.alias("token"), "ner")

    def mentions(self, df: DataFrame, text: str) -> DataFrame:
        found, numbered = self._matched(df, text)
        match = found.select(KEY, SEQ, "tokens", F.explode("matches").alias("m"))
        token = F.explode(F.sequence(F.col("m.start"), F.col("m.start") + F.col("m.size") - 1))
        return match.select(KEY, SEQ, "tokens", "m.value", token.alias("pos")).select(
            KEY, SEQ, F.col("pos").cast("bigint").alias("pos"),
            F.lower(F.get("tokens", F.col("pos"))).alias("text"),
            F.get(numbered, F.col("value")).alias("type"),
        )


class Patterns:
    """Typed regular expressions, all found in one pass over the whole text."""

    def __init__(self, patterns: dict[str, str] | None = None):
        self.patterns = dict(PATTERNS if patterns is None else patterns)

    def mentions(self, df: DataFrame, text: str) -> DataFrame:
        either = "|".join(f"(?:{p})" for p in self.patterns.values())
        found = F.regexp_extract_all(F.col(text), F.lit(either), F.lit(0))
        flat = df.where(T.has_text(text)).select(
            KEY, SEQ, F.posexplode(found).alias("pos", "hit")
        )
        kind = F.lit(None).cast("string")
        for name, pattern in reversed(list(self.patterns.items())):
            kind = F.when(F.col("hit").rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
        return flat.select(
            KEY, SEQ, F.col("pos").cast("bigint").alias("pos"), F.lower("hit").alias("text"),
            kind.alias("type"),
        )


def text_blocks(batch: pa.Array, size: int, limit: int = TEXT_BYTES) -> Iterator[pa.Array]:
    """The texts in blocks of at most ``size`` texts and ``limit`` bytes, or of one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(batch):
        before = int(ends[low - 1]) if low else 0
        high = min(low + size, max(low + 1, int(np.searchsorted(ends, before + limit, "right"))))
        yield batch.slice(low, high - low)
        low = high


class Hook:
    """A user model. ``load`` runs once per task and returns a function from a list of texts to
    a list of ``(tokens, tags)`` pairs, one per text. It gets at most ``batch_size`` texts at once,
    and no more than ``TEXT_BYTES`` of them but for one longer text."""

    def __init__(self, load: Callable[[], Callable[[list[str]], list]], batch_size: int = 1000):
        self.load, self.batch_size = load, batch_size

    def tag(self, df: DataFrame, text: str) -> DataFrame:
        load, size = self.load, self.batch_size

        def annotate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                for texts in text_blocks(batch, size):
                    found = model(texts.to_pylist())
                    columns = [pa.array([x[i] for x in found], pa.list_(pa.string())) for i in range(2)]
                    yield pa.StructArray.from_arrays(columns, names=["token", "ner"])
            give_back()

        run = F.arrow_udf(annotate, "struct<token: array<string>, ner: array<string>>")
        rows = df.where(T.has_text(text)).withColumn("_tags", run(F.col(text)))
        return rows.select(*df.columns, "_tags.token", "_tags.ner")

    def mentions(self, df: DataFrame, text: str) -> DataFrame:
        return entity_mentions(self.tag(df, text))


def tag_entities(
    df: DataFrame, tagger: Gazetteer | PhraseGazetteer | Patterns | Hook, text: str = "text"
) -> DataFrame:
    """Mentions ``video_key, arrival_seq, pos, text, type``; each comment is tagged alone."""
    return tagger.mentions(df, text)


def entity_counts(mentions: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Count, first appearance and last-seen type of each entity text per video.

    One aggregate with partial results before the shuffle, so a common entity of a large video
    travels once per task.
    """
    place = F.struct(F.col(seq).alias("seq"), F.col("pos"))
    return mentions.groupBy(key, "text").agg(
        F.count("*").alias("count"),
        F.max_by("type", place).alias("type"),
        F.min(place).alias("first_seen"),
    )


def top_entities(counts: DataFrame, n: int = TOP_ENTITIES, key: str = KEY) -> DataFrame:
    """The ``n`` most frequent entities per video; ties go by first appearance."""
    order = Window.partitionBy(key).orderBy(F.desc("count"), F.asc("first_seen"))
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select(key, "rank", "text", "type", "count")
    )


def entities_by_type(top: DataFrame, key: str = KEY) -> DataFrame:
    """Map from type to its entities in rank order, over the top entities only."""
    per_type = top.groupBy(key, "type").agg(
        F.array_sort(F.collect_list(F.struct("rank", "text", "count"))).alias("_items")
    )
    items = F.transform("_items", lambda e: F.struct(e["text"].alias("text"), e["count"].alias("count")))
    return (
        per_type.select(key, F.struct("type", items.alias("items")).alias("_entry"))
        .groupBy(key)
        .agg(F.map_from_entries(F.array_sort(F.collect_list("_entry"))).alias("entities_by_type"))
    )


def entity_totals(comments: DataFrame, counts: DataFrame, key: str = KEY) -> DataFrame:
    """Comments and mentions per video; videos without a mention are kept."""
    seen = comments.groupBy(key).agg(F.count("*").alias("total_comments"))
    mentions = counts.groupBy(key).agg(F.sum("count").alias("total_entities"))
    return seen.join(mentions, key, "left").select(
        key,
        "total_comments",
        F.col("total_comments").alias("processed_comments"),
        F.coalesce("total_entities", F.lit(0).cast("bigint")).alias("total_entities"),
    )
