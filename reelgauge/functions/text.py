"""String functions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgauge.functions.fixed import CUT_WORD, STOP_WORDS, WATCH_URL

# Java's \s under (?U) leaves out the four separators U+001C to U+001F.
_SPACE = r"[\s\x1c-\x1f]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove all Unicode white space at both ends."""
    return F.regexp_replace(_col(value), f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def shrink(value: Column | str) -> Column:
    """Squeeze runs of white space to one space and trim."""
    return F.trim(F.regexp_replace(_col(value), r"(?U)\s+", " "))


def movie_key(title: Column | str, cut_word: str = CUT_WORD) -> Column:
    """Lower-cased title before the first ``cut_word``; the whole title where it is absent."""
    return strip(F.substring_index(F.lower(_col(title)), cut_word, 1))


def video_key(title: Column | str, video_id: Column | str) -> Column:
    """Letters, digits and white space of the title, spaces as ``_``, then the id."""
    kept = F.regexp_replace(_col(title), rf"(?U)[^\p{{L}}\p{{N}}\s\x1c-\x1f]", "")
    return F.concat_ws("_", F.replace(kept, F.lit(" "), F.lit("_")), _col(video_id))


def watch_url(video_id: Column | str) -> Column:
    return F.concat(F.lit(WATCH_URL), _col(video_id))


def has_text(value: Column | str) -> Column:
    """Neither NULL nor empty; white space alone counts as text."""
    c = _col(value)
    return c.isNotNull() & (c != "")


def words(value: Column | str) -> Column:
    """Lower-cased runs of letters, for lexicon lookups. May hold empty strings at the ends."""
    return F.split(F.lower(_col(value)), r"[^\p{L}]+")


def raw_tokens(value: Column | str) -> Column:
    """Tokens between white space, case and punctuation kept."""
    return F.array_remove(F.split(shrink(value), " "), "")


def clean_tokens(
    value: Column | str, stop_words: Sequence[str] = STOP_WORDS, lower: bool = False
) -> Column:
    """White-space tokens reduced to letters and ``+``, without stop words (any case).

    The non-letters go from the whole text in one pass before the split; the tokens are the
    same as when each one is cleaned alone, since only non-space characters are removed.
    """
    letters = F.regexp_replace(_col(value), r"(?U)[^\p{L}+\s]+", "")
    if lower:
        letters = F.lower(letters)
    tokens = F.split(letters, r"(?U)\s+")
    stop = sorted({w.lower() for w in stop_words})
    if not stop:
        return F.array_remove(tokens, "")
    if lower:
        return F.filter(tokens, lambda t: (t != "") & ~t.isin(stop))
    return F.filter(tokens, lambda t: (t != "") & ~F.lower(t).isin(stop))


def tag_type(tag: Column | str) -> Column:
    """Entity type of a BIO tag: the part after the first hyphen, or the whole tag."""
    c = _col(tag)
    return F.when(c.contains("-"), F.split(c, "-")[1]).otherwise(c)


def contains_text(value: Column | str, query: str) -> Column:
    """Case-insensitive substring test; an empty query matches all."""
    return F.lower(_col(value)).contains(query.lower())
