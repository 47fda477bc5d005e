"""Quality rules: an isolation forest over rule statistics, its threshold set by labelled rows.

``rule_statistics`` reads every text once. ``fit_forest`` measures the shares of a bounded sample in
units of how far those of the rows labelled 1 reach, and grows trees by random splits on them; rows
that few splits set apart are anomalous, by one rule or by several together. ``calibrate`` places the
threshold with all labelled rows. Only statistics, never texts, are shuffled.

Defined cases: a null or empty text has no words and fails the base rules; rows that repeat a
doc_id are judged one by one; without labels of both kinds no row is rejected beyond the base rules;
an empty table gives an empty result. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import blocks, flat, saved, smallest, sums, texts_of, upper_limit

MIN_WORDS = 20
REPEAT_SHARE = 30
WINDOW = 8

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_punct", "n_digits", "n_same_words"]
_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS)


def _marks(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SPACE = _marks(b" \t\n\x0b\x0c\r")
_SYMBOL = _marks(b"#*$%&|<>")
_UPPER = _marks(bytes(range(65, 91)))
_DIGIT = _marks(b"0123456789")
_PUNCT = _marks(b"!\"'()+,-./:;=?@[\\]^_`{}~")
_CONTINUES = _marks(bytes(range(128, 192)))


def _ranked(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def repeated_words(words: list[list[bytes]], size: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of eight words found at least twice in it.

    Exact: windows are compared by ranks of their halves, and only where all their pairs repeat.
    """
    if size != 8:
        raise ValueError("ranks are doubled three times, so a window has 8 words")
    counts = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(counts, out=starts[1:])
    total = int(starts[-1])
    if total < size:
        return np.zeros(len(words), np.int64)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for x in words for w in x), np.int64, total)
    doc = np.repeat(np.arange(len(words)), counts)
    n = len(index)
    # The texts' numbers join the keys, so that equal ranks mean equal words in the same text.
    _, pair, often = np.unique((doc[:-1] * n + ids[:-1]) * n + ids[1:], return_inverse=True, return_counts=True)
    again = often[pair] > 1
    first = np.arange(total - size + 1)
    first = first[doc[first] == doc[first + size - 1]]
    first = first[again[first] & again[first + 2] & again[first + 4] & again[first + 6]]
    if not len(first):
        return np.zeros(len(words), np.int64)
    m = len(often)
    halves = _ranked(np.concatenate([pair[first] * m + pair[first + 2], pair[first + 4] * m + pair[first + 6]]))
    left, right = np.split(halves, 2)
    _, window, often = np.unique(left * (int(halves.max()) + 1) + right, return_inverse=True, return_counts=True)
    first = first[often[window] > 1]
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + size, -1)
    return sums(np.cumsum(edge[:-1]) > 0, starts)


def statistics_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    data, starts = flat(texts)
    n = len(texts)
    words = [x.split() for x in texts]
    lines = [[y for y in x.split(b"\n") if y.strip()] for x in texts]
    total = np.diff(starts)
    return {
        "n_words": np.fromiter(map(len, words), np.int64, n),
        "word_chars": total - sums(_SPACE[data], starts) - sums(_CONTINUES[data], starts),
        "n_symbols": sums(_SYMBOL[data], starts),
        "n_dup_lines": np.fromiter((len(x) - len(set(x)) for x in lines), np.int64, n),
        "n_repeat_words": repeated_words(words),
        "n_lines": np.fromiter(map(len, lines), np.int64, n),
        "n_upper": sums(_UPPER[data], starts),
        "n_punct": sums(_PUNCT[data], starts),
        "n_digits": sums(_DIGIT[data], starts),
        "n_same_words": np.fromiter((sum(map(eq, x, x[1:])) for x in words), np.int64, n),
    }


def _per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        found = statistics_of(texts_of(block))
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), *(pa.array(found[c], pa.int64()) for c in _COUNTS)], names=["doc_id", *_COUNTS])


def fails(t):
    """The base rules, on columns of Spark or pandas."""
    return (t["n_words"] < MIN_WORDS) | (100 * t["n_repeat_words"] > REPEAT_SHARE * t["n_words"])


def rule_statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text, and ``base_failed``: under 20 words, or more than 30 % of them
    in windows that repeat."""
    return (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(_per_batch, _SCHEMA)
        .withColumn("base_failed", fails({c: F.col(c) for c in _COUNTS}))
    )


#: Steps of a share in which the rows labelled 1 are counted for its limit.
SHARE_GRID = 8192


def _shares(t: pd.DataFrame) -> np.ndarray:
    """Shares that do not depend on a text's length, so that long texts are no anomaly. The last two
    are high for short words and for long ones."""
    chars, words, lines = (t[c].to_numpy(float).clip(1) for c in ("word_chars", "n_words", "n_lines"))
    short = words / chars
    return np.stack([t["n_symbols"] / chars, t["n_upper"] / chars, t["n_punct"] / chars, t["n_dup_lines"] / lines, t["n_repeat_words"] / words, t["n_same_words"] / words, short, 1 - short], 1)


SHARES = 8
#: The least unit of a share: a rule that no clean row breaks at all.
LEAST_LIMIT = 1e-3


def _known(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("long").alias("labelled_id"), F.col("quality").cast("int")).where("quality in (0, 1)")


def share_limits(statistics: DataFrame, labels: DataFrame, clean_loss: float) -> np.ndarray:
    """For each share the value that few rows labelled 1 exceed: ``clean_loss`` of them over all
    shares. 0 without such rows."""

    def per_batch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            steps = pd.DataFrame(np.ceil(_shares(part) * SHARE_GRID).astype(np.int64)).melt(var_name="share", value_name="step")
            yield steps.groupby(["share", "step"], as_index=False).size().rename(columns={"size": "n"}).astype("int64")

    clean = statistics.where(~F.col("base_failed")).join(_known(labels).where("quality = 1"), F.col("doc_id") == F.col("labelled_id"))
    counts = clean.select(_COUNTS).mapInPandas(per_batch, "share long, step long, n long").groupBy("share", "step").agg(F.sum("n").alias("n")).toPandas()  # at most one row for each share and step of the grid
    limits = np.zeros(SHARES)
    for share, found in counts.groupby("share"):
        limits[share] = upper_limit(found["step"].to_numpy() / SHARE_GRID, found["n"].to_numpy(), clean_loss / SHARES)
    return limits


def _features(t: pd.DataFrame, limits: np.ndarray) -> np.ndarray:
    """The shares in units of how far those of clean rows reach, below as above that."""
    return _shares(t) / np.maximum(limits, LEAST_LIMIT)


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), (n == 2) * 1.0)


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: ``feature`` -1 marks a leaf, whose ``cut`` is its path length. ``limits`` are
    the units of the shares that the trees see."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    rows: int
    limits: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for anomalies, below 0.5 for common rows."""
        path = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, cut, left, right in zip(self.feature, self.cut, self.left, self.right, strict=True):
            node = np.zeros(len(x), np.int64)
            while (inner := feature[node] >= 0).any():
                at = x[every, np.where(inner, feature[node], 0)]
                node = np.where(inner, np.where(at < cut[node], left[node], right[node]), node)
            path += cut[node]
        return 2.0 ** (-path / max(len(self.feature), 1) / max(float(_expected_path(self.rows)), 1e-9))


def grow(x: np.ndarray, trees: int, rows: int, seed: int) -> Forest:
    """Isolation trees, each over its own draw of ``rows`` of x. A split takes a feature with a
    chance in proportion to its extent, so that a row is set apart early by the features in which it
    lies far from the others, and common rows are not by those in which all are alike."""
    random = np.random.default_rng(seed)
    rows = min(rows, len(x))
    deepest = int(np.ceil(np.log2(max(rows, 2))))
    size = 2 ** (deepest + 1)
    shape = (trees, size)
    feature, cut, left, right = np.full(shape, -1), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    for tree in range(trees):
        used = 1
        todo = [(0, x[random.choice(len(x), rows, replace=False)], 0)]
        while todo:
            node, part, depth = todo.pop()
            low, high = part.min(0), part.max(0)
            extent = high - low
            if depth == deepest or not extent.sum() > 0:
                cut[tree, node] = depth + float(_expected_path(len(part)))
                continue
            f = random.choice(len(extent), p=extent / extent.sum())
            at = random.uniform(low[f], high[f])
            at = high[f] if at <= low[f] else at
            feature[tree, node], cut[tree, node], left[tree, node], right[tree, node] = f, at, used, used + 1
            todo += [(used, part[part[:, f] < at], depth + 1), (used + 1, part[part[:, f] >= at], depth + 1)]
            used += 2
    return Forest(feature, cut, left, right, rows)


def fit_forest(statistics: DataFrame, labels: DataFrame, trees: int = 200, rows: int = 64, sample: int = 16_384, clean_loss: float = 0.002, seed: int = 7) -> Forest | None:
    """A forest from at most ``sample`` rows that pass the base rules: those with the smallest hash
    of doc_id. The bound belongs to the method, whose trees see ``rows`` rows each."""
    passing = statistics.where(~F.col("base_failed")).select("doc_id", *_COUNTS)
    picked = smallest(passing, F.xxhash64("doc_id", F.lit(seed)), sample, _COUNTS).toPandas()
    if not len(picked):
        return None
    limits = share_limits(statistics, labels, clean_loss)
    return replace(grow(_features(picked, limits), trees, rows, seed), limits=limits)


PREFIX = "_quality_"


def with_statistics(docs: DataFrame) -> DataFrame:
    """All columns as they are, with the counts of each text in columns that begin with PREFIX."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = statistics_of(texts_of(block))
            columns = [*block.columns, *(pa.array(found[c], pa.int64()) for c in _COUNTS)]
            yield pa.RecordBatch.from_arrays(columns, names=[*block.schema.names, *(PREFIX + c for c in _COUNTS)])

    fields = StructType([*docs.schema.fields, *(StructField(PREFIX + c, LongType()) for c in _COUNTS)])
    return docs.mapInArrow(per_batch, fields)


def statistics_in(rows: DataFrame) -> DataFrame:
    """The narrow statistics of rows from ``with_statistics``."""
    counts = {c: F.col(PREFIX + c) for c in _COUNTS}
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), *(c.alias(n) for n, c in counts.items()), fails(counts).alias("base_failed"))


def passing(rows: DataFrame, forest: Forest | None, threshold: float) -> DataFrame:
    """The rows from ``with_statistics`` that pass the base rules and whose score lies below the
    threshold, without the counts. Texts do not leave the JVM."""
    kept = rows.where(~fails({c: F.col(PREFIX + c) for c in _COUNTS}))
    if forest is not None:

        @F.pandas_udf("double")
        def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for part in parts:
                yield pd.Series(scored(forest, pd.DataFrame(dict(zip(_COUNTS, part, strict=True)))))

        kept = kept.where(score(*(F.col(PREFIX + c) for c in _COUNTS)) < threshold)
    return kept.drop(*(PREFIX + c for c in _COUNTS))


def scored(forest: Forest, t: pd.DataFrame) -> np.ndarray:
    """Anomaly scores on a grid of 1/8192."""
    return np.round(forest.score(_features(t, forest.limits)) * 8192) / 8192


def with_score(statistics: DataFrame, forest: Forest | None) -> DataFrame:
    """The anomaly score of each row, on a grid of 1/8192; 0 without a forest."""
    if forest is None:
        return statistics.withColumn("anomaly", F.lit(0.0))

    def per_batch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.assign(anomaly=scored(forest, part))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in statistics.schema.fields)
    return statistics.mapInPandas(per_batch, f"{fields}, anomaly double")


def calibrate(rated: DataFrame, labels: DataFrame, clean_loss: float = 0.002) -> float:
    """The threshold that finds most rows labelled 0 while it loses at most ``clean_loss`` of those
    labelled 1. It counts all labelled rows that pass the base rules, by score and label."""
    counts = (
        rated.where(~F.col("base_failed"))
        .select("doc_id", "anomaly")
        .join(_known(labels), F.col("doc_id") == F.col("labelled_id"))
        .groupBy("anomaly")
        .agg(F.sum(F.col("quality")).alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
        .toPandas()  # at most one row for each step of the grid
        .sort_values("anomaly", ascending=False)
    )
    if not len(counts) or not counts["good"].sum() or not counts["bad"].sum():
        return 2.0
    lost = counts["good"].cumsum() / counts["good"].sum()
    caught = counts["bad"].cumsum()
    allowed = lost <= clean_loss
    if not allowed.any():
        return 2.0
    return float(counts["anomaly"][allowed & (caught == caught[allowed].max())].iloc[0])


def judged(docs: DataFrame, labels: DataFrame, trees: int = 200, rows: int = 64, sample: int = 16_384, clean_loss: float = 0.002, seed: int = 7) -> DataFrame:
    """doc_id, the statistics, base_failed, anomaly, kept: one row for each document."""
    statistics = saved(rule_statistics(docs), "rule-statistics")
    rated = saved(with_score(statistics, fit_forest(statistics, labels, trees, rows, sample, clean_loss, seed)), "rule-scores")
    threshold = calibrate(rated, labels, clean_loss)
    return rated.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))
