"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Two- and three-letter grams of the lower-cased text, runs of other characters as one blank, are hashed
into ``DIMENSIONS`` features. A feature's value is its share of the text's grams times its inverse
document frequency, which counts all documents one may learn from. The weights are trained by
follow-the-regularised-leader with L1 and L2 penalties on four fifths of these documents: in shards of
about SHARD_ROWS documents, whose weights are averaged. A language weighs as much as any other, and a
rare one lies in every shard. The last fifth, which no weight has seen, sets the temperature of the scores.

The model is a table of DIMENSIONS numbers for each language, so that predicting is one look-up and
one sum for each gram of a whole text.

The scores are shares of the learned languages and say nothing of others. ``Model.known`` does: a text
whose grams are rarer than its language's texts of that length have them is of no learned language.
The allowance comes from all rows one may learn from, each against the document frequencies of the others.

Defined cases: null text and texts without a letter get ``und`` and score 0, as all texts do where
there is nothing to learn from; a single learned language gets every other text with score 1; rows
that repeat a doc_id are predicted one by one; an empty table gives no rows. Only doc_id, text and
(for learning) lang are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, give_back, saved, texts_of, upper_limit

DIMENSIONS = 1 << 14
ORDERS = (2, 3)
#: Documents of a shard, more where a shard holds many languages, and how many of each language a
#: shard takes where there are so many; documents of rarer languages go to several shards.
SHARD_ROWS, PER_LANGUAGE = 1 << 13, 500
#: Sums over documents are of integers, in units of 1 / UNIT, so that they do not depend on the order
#: of the tasks; deviations are counted on a grid of 1 / STEP up to FAR.
UNIT, STEP, FAR = float(1 << 24), 256, 1024
#: The divisors of the logits that are tried.
TEMPERATURES = np.geomspace(0.05, 20, 121)
#: Weights that are averaged together.
SLICE = 1 << 14
UNKNOWN = "und"
#: The share of the texts of a language one may learn from whose grams may be called too rare for their language.
KNOWN_LOSS = 0.0005
#: Bytes of text whose grams a task holds at once.
GRAM_BYTES = 1 << 20


@cache
def _letters() -> np.ndarray:
    """For each code point its lower case, or a blank where it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of all grams, where each text's begin (and the last end), and whether a text
    has a letter."""
    decoded = [x.decode("utf-8", "replace") for x in texts]
    sizes = np.fromiter(map(len, decoded), np.int64, len(decoded)) + 2
    code = _letters()[np.frombuffer((" " + "  ".join(decoded) + " ").encode("utf-32-le"), np.uint32)]
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    blank = code == 32
    keep = ~blank | ~np.append(False, blank[:-1])
    keep[ends - sizes] = True
    code, text = code[keep], text[keep]
    letters = np.bincount(text[code != 32], minlength=len(texts)) > 0
    # Every text has one gram for each of its characters and order but the last ones.
    found, owner = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for n in ORDERS:
        if len(code) < n:
            continue
        value = np.full(len(code) - n + 1, n, np.uint32)
        for i in range(n):
            value = (value ^ code[i:len(code) - n + 1 + i]) * np.uint32(0x9E3779B1)
            value ^= value >> np.uint32(15)
        inside = text[:len(value)] == text[n - 1:]
        found.append((value & np.uint32(DIMENSIONS - 1))[inside])
        owner.append(text[:len(value)][inside])
    feature, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(texts)), out=starts[1:])
    return feature[order].astype(np.int64), starts, letters


@dataclass(frozen=True)
class Model:
    """``table``: weight times inverse document frequency of each feature and language. ``rarity`` is
    the latter alone, ``usual`` its mean over the grams of each language's texts, whose variance is
    ``between`` texts plus ``within`` over their grams; ``limit`` of each is in such deviations."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    rarity: np.ndarray
    usual: np.ndarray
    limit: np.ndarray
    between: float = 0.0
    within: float = 1.0

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best, score, letters = self._chosen(*grams(texts))
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist(), strict=True)]
        return names, score

    def known(self, texts: list[bytes]) -> np.ndarray:
        """Whether a text is of a learned language."""
        if not self.languages:
            return np.zeros(len(texts), bool)
        feature, starts, letters = grams(texts)
        best, _, _ = self._chosen(feature, starts, letters)
        count = np.maximum(np.diff(starts), 1)
        total = np.append(0.0, np.cumsum(self.rarity[feature]))
        above = (total[starts[1:]] - total[starts[:-1]]) / count - self.usual[best]
        return letters & (above <= self.limit[best] * np.sqrt(self.between + self.within / count))

    def _chosen(self, feature: np.ndarray, starts: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logits = np.empty((len(letters), len(self.languages)))
        count = np.maximum(np.diff(starts), 1)
        for k in range(len(self.languages)):
            total = np.zeros(len(feature) + 1)
            np.cumsum(self.table[:, k][feature], out=total[1:])
            logits[:, k] = (total[starts[1:]] - total[starts[:-1]]) / count + self.bias[k]
        chance = _softmax(logits / self.temperature)
        best = chance.argmax(1)
        return best, np.where(letters, chance[np.arange(len(letters)), best], 0.0), letters


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


Row = tuple[np.ndarray, np.ndarray]


def _dense(rows: list[Row]) -> np.ndarray:
    x = np.zeros((len(rows), DIMENSIONS + 1), np.float32)
    x[:, -1] = 1  # for the bias
    for i, (feature, value) in enumerate(rows):
        x[i, feature] = value
    return x


def train(rows: list[Row], y: np.ndarray, classes: int, alpha: float = 1.0, beta: float = 0.005, l1: float = 0.002, l2: float = 0.01, updates: int = 256, batch: int = 32, seed: int = 3) -> np.ndarray:
    """Weights, the last row of them biases, by follow-the-regularised-leader; L1 keeps rare
    evidence at zero. Every row is used, as often as the number of updates asks for."""
    random = np.random.default_rng(seed)
    z, n = np.zeros((DIMENSIONS + 1, classes)), np.zeros((DIMENSIONS + 1, classes))
    target = np.eye(classes)[y]
    times = np.bincount(y, minlength=classes)
    each = len(y) / np.count_nonzero(times) / np.maximum(times, 1)
    updates = max(updates, -(-len(rows) // batch))

    def weights() -> np.ndarray:
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        w[np.abs(z) <= l1] = 0
        return w

    order = np.concatenate([random.permutation(len(rows)) for _ in range(-(-updates * batch // len(rows)))])
    for at in range(0, updates * batch, batch):
        some = order[at:at + batch]
        part = _dense([rows[i] for i in some])
        w = weights()
        gradient = part.T @ ((_softmax(part @ w) - target[some]) * each[y[some], None]) / len(some)
        grown = n + gradient**2
        z += gradient - (np.sqrt(grown) - np.sqrt(n)) / alpha * w
        n = grown
    return weights()


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def squeezed(feature: np.ndarray, n: np.ndarray) -> bytes:
    """A text's features (ascending) and how often each occurs, compressed."""
    return zlib.compress(np.diff(feature, prepend=0).astype("<u2").tobytes() + n.astype("<u4").tobytes(), 1)


def expanded(held: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(held)
    size = len(raw) // 6
    return np.cumsum(np.frombuffer(raw, "<u2", size), dtype=np.int64), np.frombuffer(raw, "<u4", size, 2 * size).astype(np.int64)


def counted(rows: DataFrame, seed: int) -> DataFrame:
    """lang, rank (a hash of doc_id), letters, held: the feature counts of each text, so that no text
    is cut into grams twice."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, GRAM_BYTES):
            feature, starts, letters = grams(texts_of(block))
            held = [squeezed(*np.unique(feature[a:b], return_counts=True)) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("lang"), block.column("rank"), pa.array(letters), pa.array(held, pa.binary())], names=["lang", "rank", "letters", "held"])

    ranked = rows.select("lang", F.xxhash64("doc_id", F.lit(seed)).alias("rank"), "text")
    return ranked.mapInArrow(per_task, "lang string, rank long, letters boolean, held binary")


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """In how many of the ``counted`` texts each feature occurs, and, last, the number of texts."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for held in batch.column("held"):
                total[expanded(held.as_py())[0]] += 1
            total[-1] += batch.num_rows
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["feature", "n"])

    counts = rows.select("held").mapInArrow(per_task, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(DIMENSIONS + 1, np.int64)
    for feature, n in counts:
        found[feature] = n
    return found


def _by_language(languages: tuple[str, ...], values: list) -> Column:
    return F.create_map(*[F.lit(x) for pair in zip(languages, values, strict=True) for x in pair])[F.col("lang")]


def allowance(rows: DataFrame, languages: tuple[str, ...], frequency: np.ndarray) -> dict[str, np.ndarray | float]:
    """``usual``, ``between``, ``within`` and ``limit`` of a model from all ``counted`` rows.

    Each row is held against the frequencies and the mean of the others. A language's only row is
    held against nothing."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = np.log(frequency[-1] / np.maximum(frequency[:-1], 1)) + 1
        for batch in batches:
            found = np.zeros((batch.num_rows, 3))
            for i, held in enumerate(batch.column("held")):
                feature, n = expanded(held.as_py())
                total = n.sum()
                mean = rare[feature] @ n / total
                found[i] = mean, np.square(rare[feature]) @ n / total - mean * mean, total
            columns = np.rint(found * [UNIT, UNIT, 1]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), *map(pa.array, columns.T.copy())], names=["lang", "mean", "spread", "grams"])

    each = saved(rows.select("lang", "held").mapInArrow(per_task, "lang string, mean long, spread long, grams long"), "gram-rarity")
    sums = {r["lang"]: r for r in each.groupBy("lang").agg(F.count("*").alias("n"), F.sum("mean").alias("mean"), F.sum("spread").alias("spread")).collect()}
    n = np.array([sums[x]["n"] for x in languages])
    usual = np.array([sums[x]["mean"] / sums[x]["n"] / UNIT for x in languages])
    within = sum(r["spread"] for r in sums.values()) / UNIT / int(n.sum())
    limit = np.full(len(languages), np.inf)
    if not (n > 1).any():
        return {"usual": usual, "limit": limit}
    many = _by_language(languages, n.tolist())
    above = (F.col("mean") / UNIT - _by_language(languages, usual.tolist())) * many / (many - 1)
    paired = each.where(many > 1)
    excess = F.round((above * above - F.lit(within) / F.col("grams")) * UNIT).cast("long")
    between = max(paired.agg(F.sum(excess)).first()[0] / UNIT / int(n[n > 1].sum()), 0.0)
    within = max(within, 1e-9)
    apart = above / F.sqrt(F.lit(between) + F.lit(within) / F.col("grams"))
    cell = F.ceil(F.greatest(F.lit(-float(FAR)), F.least(F.lit(float(FAR)), apart)) * STEP)
    for name, cells in paired.groupBy("lang", cell.alias("cell")).count().groupBy("lang").agg(F.collect_list(F.struct("cell", "count"))).collect():
        limit[languages.index(name)] = upper_limit(np.array([c for c, _ in cells]) / STEP, np.array([k for _, k in cells]), KNOWN_LOSS)
    return {"usual": usual, "limit": limit, "between": between, "within": within}


def _unseen() -> Column:
    """The rows that set the temperature."""
    return F.pmod("rank", F.lit(5)) == 0


def _shares(held: bytes, idf: np.ndarray) -> Row:
    feature, n = expanded(held)
    return feature.astype(np.uint16), (n / n.sum() * idf[feature]).astype(np.float32)


def weights_of(rows: DataFrame, counts: dict[str, int], languages: tuple[str, ...], idf: np.ndarray) -> np.ndarray:
    """The mean of the weights of all shards; ``counts`` are those of the rows' languages. A task holds
    one shard, the driver the mean."""
    shards = max(1, round(sum(counts.values()) / max(SHARD_ROWS, 2 * PER_LANGUAGE * len(languages))))
    copies = [min(shards, -(-shards * PER_LANGUAGE // max(counts.get(x, 0), 1))) for x in languages]
    number = {x: i for i, x in enumerate(languages)}

    def learned(name: int, y: list[int], found: list[Row]) -> pa.RecordBatch:
        flat = train(found, np.array(y), len(languages)).ravel()
        cut = [flat[i:i + SLICE].tobytes() for i in range(0, len(flat), SLICE)]
        return pa.RecordBatch.from_arrays([pa.array([name] * len(cut), pa.int32()), pa.array(np.arange(len(cut), dtype=np.int32)), pa.array(cut, pa.binary())], names=["shard", "slice", "weights"])

    def per_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, y, found = None, [], []
        for batch in batches:
            for shard, lang, held in zip(*(batch.column(c) for c in ("shard", "lang", "held")), strict=True):
                if shard.as_py() != name:
                    if y:
                        yield learned(name, y, found)
                    name, y, found = shard.as_py(), [], []
                y.append(number[lang.as_py()])
                found.append(_shares(held.as_py(), idf))
        if y:
            yield learned(name, y, found)
        give_back()

    def mean(part: pd.DataFrame) -> pd.DataFrame:
        held = part.sort_values("shard")["weights"]
        return pd.DataFrame({"slice": part["slice"].iloc[:1], "weights": [(sum(map(np.frombuffer, held)) / len(held)).tobytes()]})

    turn = F.explode(F.sequence(F.lit(0), _by_language(languages, copies) - 1))
    dealt = rows.select("lang", "rank", "held", turn.alias("turn")).withColumn("shard", F.pmod(F.shiftright("rank", 8) + F.col("turn"), F.lit(shards)).cast("int"))
    ordered = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "rank", "lang", "held")
    parts = ordered.select("shard", "lang", "held").mapInArrow(per_shard, "shard int, slice int, weights binary")
    found = parts.groupBy("slice").applyInPandas(mean, "slice int, weights binary").collect()
    return np.concatenate([np.frombuffer(r["weights"]) for r in sorted(found, key=lambda r: r["slice"])]).reshape(DIMENSIONS + 1, -1)


def temperature(rows: DataFrame, counts: dict[str, int], languages: tuple[str, ...], idf: np.ndarray, weights: np.ndarray) -> float:
    """The divisor of the logits under which the languages of the rows are likeliest, each language
    weighing the same."""
    number = {x: i for i, x in enumerate(languages)}

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = np.zeros((len(languages), len(TEMPERATURES)), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            y = np.array([number[x] for x in batch.column("lang").to_pylist()])
            logits = np.stack([weights[f].T @ v + weights[-1] for f, v in (_shares(x.as_py(), idf) for x in batch.column("held"))])
            for i, t in enumerate(TEMPERATURES):
                chance = _softmax(logits / t)[np.arange(len(y)), y]
                np.add.at(loss[:, i], y, np.rint(-np.log(np.maximum(chance, 1e-300)) * UNIT).astype(np.int64))
        lang, step = np.indices(loss.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(step), pa.array(loss.ravel())], names=["lang", "step", "loss"])

    loss = np.zeros(len(TEMPERATURES))
    sums = rows.select("lang", "held").mapInArrow(per_task, "lang long, step long, loss long").groupBy("lang", "step").agg(F.sum("loss").alias("loss"))
    for lang, step, total in sorted(tuple(r) for r in sums.collect()):  # a row for each language and divisor
        loss[step] += total / max(counts.get(languages[lang], 0), 1)
    return float(TEMPERATURES[int(np.argmin(loss))])


def fit(docs: DataFrame, seed: int = 5) -> Model:
    """A model from all documents one may learn from. The driver receives the counts of the features,
    the mean weights and, for each language, counts on grids."""
    rows = saved(counted(learnable(docs), seed), "feature-counts")
    frequency = document_frequencies(rows)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    rows = rows.where("letters")
    sizes = [tuple(r) for r in rows.groupBy("lang", _unseen().alias("unseen")).count().collect()]
    languages = tuple(sorted({lang for lang, _, _ in sizes}))
    if not languages:
        return Model((), np.zeros((DIMENSIONS, 0)), np.zeros(0), 1.0, idf, np.zeros(0), np.zeros(0))
    allowed = allowance(rows, languages, frequency)
    if len(languages) < 2:
        return Model(languages, np.zeros((DIMENSIONS, 1)), np.zeros(1), 1.0, idf, **allowed)
    seen, unseen = ({lang: n for lang, later, n in sizes if later == kind} for kind in (False, True))
    weights = weights_of(rows.where(~_unseen()), seen, languages, idf) if seen else np.zeros((DIMENSIONS + 1, len(languages)))
    scale = temperature(rows.where(_unseen()), unseen, languages, idf, weights) if seen and unseen else 1.0
    return Model(languages, weights[:-1] * idf[:, None], weights[-1], scale, idf, **allowed)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, GRAM_BYTES):
            names, score = model.predict(texts_of(block))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(per_batch, "doc_id long, lang_pred string, score double").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
