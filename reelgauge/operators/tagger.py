"""A trained entity tagger: an averaged structured perceptron over BIO tags with Viterbi decoding.

Features are hashed into a fixed number of buckets, so that model, messages and broadcasts do not
grow with the vocabulary. Training mixes parameters: in each epoch every shard of the sentences
starts from the mixed weights and runs alone; the differences are summed by blocks of buckets and
averaged. The model is the mean of the weights over all steps, shards and epochs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reelgauge.functions import text as T
from reelgauge.operators.entities import KEY, SEQ, name_tokens
from reelgauge.operators.joins import kept
from reelgauge.operators.phrases import list_blocks
from reelgauge.session import give_back, stored

BUCKETS, BLOCK = 1 << 16, 1 << 10
TEMPLATES = 8
#: Training cuts token lists into sentences of about so many tokens, never inside an entity, and
#: updates a shard's weights after so many sentences.
SENTENCE, BATCH = 40, 8
#: Tokens that a task holds with their features at once (one longer text makes a block of its own)
#: and the least and the most updates' sentences decoded ahead.
BLOCK_TOKENS, LEAST, AHEAD = 1 << 17, 8, 64
_WIDE = np.uint64(0x9E3779B97F4A7C15)
#: Tokens whose emissions are summed at once; letters up to which a token's codes are found by arrays.
SUMMED, SHORT = 1 << 12, 64
#: Longer sentences are decoded in pieces of so many tokens, with an eighth more on either side.
PIECE = 128
#: From so many sums a step, ways are added by one tag before after the other.
MANY = 1 << 14
#: How much more than rounding a margin has to be.
SLACK = 1e-6


def shape(token: str) -> str:
    """Upper case X, lower case x, digits 0, anything else as it is; runs shortened."""
    kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c for c in token)
    return re.sub(r"(.)\1{2,}", r"\1\1", kinds)


def _code(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) + 1


@cache
def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of each letter met so far its lower case, 0 where that depends on what stands beside it or is
    not one letter, and its kind in a shape, 0 where it was not met."""
    return np.zeros(0x110000, np.uint32), np.zeros(0x110000, np.uint32)


def _piece_codes(letters: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``_code`` of the pieces from ``begin`` to ``end``, a byte of all of them at a time."""
    data = np.frombuffer(letters.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
    width = 1 + (letters > 0x7F).astype(np.int64) + (letters > 0x7FF) + (letters > 0xFFFF)
    places = np.concatenate([[0], np.cumsum(width)])
    begin, size = places[begin], places[end] - places[begin]
    order = np.argsort(-size.astype(np.int16), kind="stable")  # at most 4 bytes a letter
    at, falling = begin[order], -size[order]
    table, state = _crc_table(), np.full(len(size), 0xFFFFFFFF, np.uint32)
    for i in range(int(size.max(initial=0))):
        n = int(np.searchsorted(falling, -i, "left"))
        now = state[:n]
        state[:n] = table[(now ^ data[at[:n] + i]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(size), np.uint64)
    out[order] = (state ^ np.uint32(0xFFFFFFFF)).astype(np.uint64) + np.uint64(1)
    return out


def _codes(names: pa.Array) -> np.ndarray:
    """Codes of word, shape, ending and beginning of each token (token x 4), letter by letter for all
    tokens together but those that are long or have a letter without a lower case of its own."""
    size = pc.utf8_length(names).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    places = np.frombuffer(names.buffers()[1] or bytes(4), np.int32)[names.offset:]
    text = memoryview(names.buffers()[2] or b"")[places[0]:places[len(names)]] if len(names) else b""
    text = np.frombuffer(str(text, "utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    low, kind = _letters()
    for c in np.unique(text[kind[text] == 0]).tolist():
        x = chr(c)
        kind[c] = ord(shape(x))
        low[c] = ord(x.lower()) if len(x.lower()) == 1 and x not in "\u03a3\n" else 0
    lower, kinds = low[text], kind[text]
    odd = np.concatenate([[0], np.cumsum(lower == 0)])
    slow = (odd[ends] != odd[ends - size]) | (size > SHORT)
    out = np.empty((len(names), 4), np.uint64)
    for i in np.flatnonzero(slow).tolist():
        x = names[i].as_py()
        out[i] = _code(x.lower()), _code(shape(x)), _code(x[-3:].lower()), _code(x[:2].lower())
    end, size = ends[~slow], size[~slow]
    begin = end - size
    run = np.zeros(len(text), bool)  # a third of the same kind
    run[2:] = (kinds[2:] == kinds[1:-1]) & (kinds[2:] == kinds[:-2])
    for i in (0, 1):
        run[begin[size > i] + i] = False  # what stands before is another token's
    held = np.concatenate([[0], np.cumsum(~run)])
    out[~slow, 0] = _piece_codes(lower, begin, end)
    out[~slow, 1] = _piece_codes(kinds[~run], held[begin], held[end])
    out[~slow, 2] = _piece_codes(lower, np.maximum(begin, end - 3), end)
    out[~slow, 3] = _piece_codes(lower, begin, np.minimum(begin + 2, end))
    return out


def _mixed_bucket(codes: np.ndarray, template: int, buckets: int) -> np.ndarray:
    mixed = (codes + np.uint64(template + 1)) * _WIDE
    mixed ^= mixed >> np.uint64(31)
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)
    return (mixed & np.uint64(buckets - 1) if buckets & (buckets - 1) == 0 else mixed % np.uint64(buckets)).astype(np.int64)


def features(tokens: Sequence[str] | pa.Array, lengths: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the features of each token (token x template); ``lengths`` are those of the
    sentences, which lie end to end."""
    if not len(tokens):
        return np.zeros((0, TEMPLATES), np.int64)
    coded = (tokens if isinstance(tokens, pa.Array) else pa.array(tokens, pa.string())).dictionary_encode()
    codes, at = _codes(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    filled = lengths > 0
    first, last = (ends - lengths)[filled], (ends - 1)[filled]

    def moved(x: np.ndarray, by: int, none) -> np.ndarray:
        """What stands before or after each token, ``none`` where that is another sentence's."""
        x = np.roll(x, by)
        x[first if by > 0 else last] = none
        return x

    out = np.empty((TEMPLATES, len(tokens)), np.int64)
    none = np.zeros(1, np.uint64)
    # Word, ending, beginning and shape are mixed once for each distinct token.
    for i, code, by in ((0, 0, 0), (1, 0, 1), (2, 0, -1), (3, 2, 0), (4, 3, 0), (5, 1, 0)):
        column = _mixed_bucket(codes[:, code], i, buckets)[at]
        out[i] = moved(column, by, _mixed_bucket(none, i, buckets)[0]) if by else column
    form = codes[:, 1][at]
    for i, by in ((6, 1), (7, -1)):
        out[i] = _mixed_bucket(moved(form, by, 0) * _WIDE + form, i, buckets)
    return out.T


def allowed(tags: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """0 or minus infinity: of each tag at the start, and after each tag. I-X follows B-X or I-X."""
    start, step = np.zeros(len(tags)), np.zeros((len(tags), len(tags)))
    for j, tag in enumerate(tags):
        if tag.startswith("I-"):
            start[j] = -np.inf
            step[[i for i, x in enumerate(tags) if x[2:] != tag[2:] or x == "O"], j] = -np.inf
    return start, step


def _advance(step: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """From the scores of a token's tags (tag x sentence) the best ways to each tag of the next."""
    n = len(step)
    free = np.flatnonzero(np.isfinite(step).all(0))
    bound = np.setdiff1d(np.arange(n), free)
    ways = [np.flatnonzero(np.isfinite(step[:, j])) for j in bound]
    most = max([1, *map(len, ways)])
    # The few ways to an I-X; where there are less, one of them again.
    before = np.array([np.resize(x, most) if len(x) else np.zeros(most, int) for x in ways], np.int64).reshape(-1, most).T
    added, to_free = step[before, bound][:, :, None], np.ascontiguousarray(step[:, free])[:, :, None]

    def advance(scores: np.ndarray) -> np.ndarray:
        if n * scores.size < MANY:
            return (scores[:, None] + step[:, :, None]).max(0)
        out = np.empty_like(scores)
        if len(free):
            best = scores[0] + to_free[0]
            other = np.empty_like(best)
            for i in range(1, n):
                np.maximum(best, np.add(scores[i], to_free[i], out=other), out=best)
            out[free] = best
        if len(bound):
            out[bound] = (scores[before] + added).max(0)
        return out

    return advance


def _paths(emissions: np.ndarray, at: np.ndarray, lengths: np.ndarray, start: np.ndarray, step: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, Callable[[np.ndarray, np.ndarray], np.ndarray]]:
    """The best tags of stretches of tokens that begin ``at``, one step of all at a time, and the scores
    (tag x stretch) of given stretches at a given step of each. ``start`` and ``end`` have a column for
    each stretch."""
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    longest = int(size[0]) if len(size) else 0
    open_ = np.searchsorted(-size, -np.arange(longest + 1), "left")  # stretches longer than t
    # Step by step, the longest stretches first.
    low = np.concatenate([[0], np.cumsum(open_)])
    when = np.repeat(np.arange(longest), open_[:-1])
    who = np.arange(len(when)) - low[when]
    scores = np.ascontiguousarray(emissions[at[order][who] + when].T)
    bounds, advance = low.tolist(), _advance(step)
    scores[:, :bounds[1]] += start[:, order[:bounds[1]]]
    for t in range(1, longest):
        here, before = bounds[t], bounds[t - 1]
        n = bounds[t + 1] - here
        scores[:, here:here + n] += advance(scores[:, before:before + n])
    filled = order[:bounds[1]]
    now = (scores[:, low[size[:len(filled)] - 1] + np.arange(len(filled))] + end[:, filled]).argmax(0)  # each stretch's last
    found = np.empty(len(when), np.int64)
    for t in range(longest - 1, -1, -1):
        here, n = bounds[t], bounds[t + 1] - bounds[t]
        if after := bounds[t + 2] - bounds[t + 1]:
            now[:after] = (scores[:, here:here + after] + step[:, now[:after]]).argmax(0)
        found[here:here + n] = now[:n]
    tags = np.empty(len(when), np.int64)
    tags[(np.cumsum(lengths) - lengths)[order][who] + when] = found
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return tags, lambda some, t: scores[:, low[t] + place[some]]


def viterbi(emissions: np.ndarray, lengths: np.ndarray, start: np.ndarray, step: np.ndarray, end: np.ndarray | None = None, piece: int = PIECE) -> np.ndarray:
    """The best tags of all sentences, those of long ones from pieces that are decoded together.
    ``start`` and ``end`` are the same for all, or have a column for each sentence.

    A piece begins and ends some tokens outside. It is right if the scores before its first token are
    those of the piece before but for a constant, since then all that follows is the same, and if the
    piece before ends in its first tag. A sentence with another piece is decoded in longer ones.
    """
    lengths, aside = np.asarray(lengths, np.int64), piece // 8
    at = np.cumsum(lengths) - lengths
    count = np.maximum(1, -(-lengths // piece))
    of = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    own = at[of] + number * piece
    stop = (at + lengths)[of]
    own_size = np.minimum(own + piece, stop) - own
    low, high = np.where(number > 0, own - aside, own), np.minimum(own + own_size + aside, stop)
    later = np.flatnonzero(number > 0)
    start, end = (np.broadcast_to(x.reshape(len(step), -1), (len(step), len(lengths))) for x in (start, np.zeros(len(step)) if end is None else end))
    starts, stops = (start[:, of], end[:, of]) if len(later) else (start, end)
    if len(later):
        starts[:, number > 0] = stops[:, high < stop] = 0
    tags, scores = _paths(emissions, low, high - low, starts, step, stops)
    from_ = np.cumsum(high - low) - (high - low)
    out = tags[np.repeat(from_ + own - low - (np.cumsum(own_size) - own_size), own_size) + np.arange(len(emissions))]
    if not len(later):
        return out
    behind = later - 1
    mine = scores(later, np.full(len(later), aside - 1))
    theirs = scores(behind, np.where(number[behind] > 0, piece + aside, piece) - 1)
    with np.errstate(invalid="ignore"):
        apart = np.ptp(theirs - mine, axis=0)
        close = apart <= 1e-11 * (1 + np.maximum(np.abs(theirs).max(0), np.abs(mine).max(0)))
    right = close & (tags[from_[behind] + own[later] - low[behind]] == tags[from_[later] + aside])
    again = np.unique(of[later[~right]])
    if len(again):
        size = lengths[again]
        rows = np.repeat(at[again] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out[rows] = viterbi(emissions[rows], size, start[:, again], step, end[:, again], 8 * piece)
    return out


class _Doubt:
    """Finds the tokens that may be in an entity; all others are ``O`` in every best path.

    With parts of the steps moved to the tags (``leave`` and ``enter``), no step is better than from
    ``O`` to ``O``. A token is plain if ``O`` is then its best tag, by a margin. Where a path is not
    ``O`` in a run of plain tokens, it gains their margins by becoming ``O`` there and loses at most
    ``left`` where it comes from another tag before the run, and ``right`` where it goes on behind it
    (an I-X there needs a B-X as the run's last tag, ``turned``). So a token is ``O`` where the margins
    from the run's first token on and those up to its last but one are more than that.
    """

    def __init__(self, tags: list[str], start: np.ndarray, step: np.ndarray):
        n, out = len(tags), tags.index("O")
        some = np.arange(n) != out
        more = step - step[out, out]
        leave, enter = np.zeros(n), np.zeros(n)
        leave[some] = np.maximum(more[some, out], more[some][:, some].max(1, initial=-np.inf) / 2)
        enter[some] = np.maximum(more[out, some], (more[some][:, some] - leave[some][:, None]).max(0, initial=-np.inf))
        enter[some & ~np.isfinite(enter)] = 0
        leave[some] = np.maximum(more[some, out], (more[some][:, some] - enter[some]).max(1, initial=-np.inf))
        moved = more - leave[:, None] - enter
        first = start - enter
        inside = np.array([t.startswith("I-") for t in tags])
        kinds = [t[2:] for t in tags if t.startswith("I-")]
        self.usable = n > 1 and all("B-" + x in tags for x in kinds) and bool(np.isfinite(leave).all() and np.isfinite(moved[:, out]).all())
        if not self.usable:
            return
        self.out, self.added = out, leave + enter
        self.b, self.i = [tags.index("B-" + x) for x in kinds], [tags.index("I-" + x) for x in kinds]
        self.left = max(0.0, (moved - moved[:, [out]]).max(), (first - first[out]).max()) + SLACK
        self.right = max(0.0, (moved[:, ~inside] - moved[out, ~inside]).max(), -leave.min()) + SLACK
        if kinds:
            self.right = max(self.right, -moved[out, self.b].min() + max(0.0, (moved[self.i, self.i] - moved[self.b, self.i]).max()) + SLACK)

    def margins(self, emissions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of tokens (tag x token) the margin of ``O`` and what a B-X loses at most against I-X."""
        moved = emissions + self.added[:, None]
        turned = np.maximum(0, (moved[self.i] - moved[self.b]).max(0)) if self.b else np.zeros(moved.shape[1])
        own = moved[self.out].copy()
        moved[self.out] = -np.inf
        return own - moved.max(0) - SLACK, turned

    def open_tokens(self, margin: np.ndarray, turned: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether each token may be in an entity."""
        n = len(margin)
        at = np.arange(n)
        plain = margin > 0
        ends = np.cumsum(lengths)[lengths > 0]
        begins = np.zeros(n + 1, bool)  # of a run of plain tokens, or of none
        begins[0] = begins[ends] = True
        begins[1:-1] |= ~plain[1:] | ~plain[:-1]
        low = np.flatnonzero(begins)
        run = np.cumsum(begins[:-1]) - 1
        first, last = low[run], low[run + 1] - 1
        total = np.concatenate([[0.0], np.cumsum(np.where(plain, margin, 0))])
        left = total[at + 1] - total[first]
        right = total[np.maximum(last, at + 1)] - total[at + 1]
        return ~(plain & (left > self.left) & (right > self.right + turned[last]))


class Weights:
    """Emission weights (bucket x tag) with the transitions and starts as further rows."""

    def __init__(self, tags: list[str], buckets: int = BUCKETS, values: np.ndarray | None = None):
        self.tags, self.buckets = tags, buckets
        rows = -(-(buckets + len(tags) + 1) // BLOCK) * BLOCK
        self.values = np.zeros((rows, len(tags))) if values is None else values
        self.start_rule, self.step_rule = allowed(tags)

    def decode(self, found: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, b = len(self.tags), self.buckets
        start, step = self.values[b + n] + self.start_rule, self.values[b:b + n] + self.step_rule
        doubt = _Doubt(self.tags, start, step) if "O" in self.tags else None
        scores, one = np.empty((len(found), n)), np.empty((min(SUMMED, len(found)), n))
        margin, turned = np.empty(len(found)), np.empty(len(found))
        for low in range(0, len(found), SUMMED):
            some = np.ascontiguousarray(found[low:low + SUMMED].T, np.intp)
            total, part = scores[low:low + SUMMED], one[:some.shape[1]]
            np.take(self.values, some[0], 0, total, "clip")
            for column in some[1:]:
                total += np.take(self.values, column, 0, part, "clip")
            if doubt is not None and doubt.usable:
                margin[low:low + SUMMED], turned[low:low + SUMMED] = doubt.margins(np.ascontiguousarray(total.T))
        if doubt is None or not doubt.usable or not len(found):
            return viterbi(scores, lengths, start, step)
        held = doubt.open_tokens(margin, turned, lengths)
        out = np.full(len(found), doubt.out, np.int64)
        where = np.flatnonzero(held)
        if len(where):
            ends = np.cumsum(lengths)[lengths > 0]
            first, last = np.zeros(len(held), bool), np.zeros(len(held), bool)
            first[0] = first[ends[:-1]] = last[ends - 1] = True
            cut = np.flatnonzero(first[where] | ~held[where - 1])  # the first token of all begins a sentence
            size = np.diff(cut, append=len(where))
            starts = np.where(first[where[cut]], start[:, None], step[doubt.out][:, None])
            stops = np.where(last[where[cut + size - 1]], 0.0, step[:, doubt.out][:, None])
            out[where] = viterbi(scores[where], size, starts, step, stops)
        return out


def _sentence_lengths(inside: np.ndarray) -> list[int]:
    """The lengths of the sentences that a list of tags is cut into, ``inside`` being those that go on
    with an entity."""
    out, low = [], 0
    while low < len(inside):
        high = low + SENTENCE
        while high < len(inside) and inside[high]:
            high += 1
        out.append(min(high, len(inside)) - low)
        low = high
    return out


def _prepared(buckets: int):
    """Each token list as its sentences' lengths, the buckets of their features and the numbers of
    their tags in ``names``, so that no epoch looks at a token again."""
    wide = np.dtype(np.uint16 if buckets <= 1 << 16 else np.uint32)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in list_blocks(batch, "token", BLOCK_TOKENS):
                lists = block.column("token")
                sizes = np.diff(lists.offsets.to_numpy())
                coded = block.column("ner").flatten().dictionary_encode()
                names, tags = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                rows = [tags[e - n:e] for e, n in zip(ends, sizes, strict=True)]
                inside = np.array([x.startswith("I-") for x in names], bool)[tags]
                lengths = [np.array(_sentence_lengths(inside[e - n:e]), np.int32) for e, n in zip(ends, sizes, strict=True)]
                found = features(lists.flatten(), np.concatenate(lengths).astype(np.int64), buckets).astype(wide, "C")
                used, gold = [], []
                for x in rows:
                    some = np.flatnonzero(np.bincount(x, minlength=len(names)))
                    number = np.zeros(len(names), np.uint16)
                    number[some] = np.arange(len(some))
                    used.append([names[i] for i in some])
                    gold.append(number[x].tobytes())
                columns = [pa.array([x.tobytes() for x in lengths], pa.binary()), pa.array([found[e - n:e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary()), pa.array(gold, pa.binary()), pa.array(used, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([block.column("shard"), block.column("_order"), *columns], names=["shard", "_order", "lengths", "found", "gold", "names"])
        give_back()

    return per_task


def _rows_of(found: np.ndarray, lengths: np.ndarray, tags: np.ndarray, buckets: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells of the weights that a tagging uses."""
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    before = np.concatenate([[0], tags[:-1]]) + buckets
    before[starts] = buckets + n
    return np.concatenate([found.ravel(), before]), np.concatenate([np.repeat(tags, TEMPLATES), tags])


class _Shard:
    """The running weights of one shard. An update follows each ``BATCH`` sentences, but sentences
    are decoded ahead: up to the first wrong update all guesses are those of the weights that it
    would have met, and the guesses after it are dropped."""

    def __init__(self, tags: list[str], buckets: int, first: np.ndarray):
        self.weights, self.first = Weights(tags, buckets, first.copy()), first
        self.later, self.steps, self.ahead = np.zeros_like(first), 0, 1
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, lengths: np.ndarray, found: np.ndarray, gold: np.ndarray) -> None:
        self.held.append((lengths, found, gold))
        self.count += len(lengths)
        if self.count >= AHEAD * BATCH:
            self.run(False)

    def run(self, whole: bool) -> None:
        """Learn from the sentences held, all of them or whole updates only."""
        if not self.held:
            return
        lengths, found, gold = (np.concatenate(x) for x in zip(*self.held, strict=True))
        at = np.concatenate([[0], np.cumsum(lengths)])
        low, stop = 0, len(lengths) if whole else len(lengths) // BATCH * BATCH
        while low < stop:
            high = min(low + self.ahead * BATCH, stop)
            guess = self.weights.decode(found[at[low]:at[high]], lengths[low:high])
            wrong = np.flatnonzero(guess != gold[at[low]:at[high]])
            if not len(wrong):
                self.steps += -(-(high - low) // BATCH)
                low, self.ahead = high, min(2 * self.ahead, AHEAD)
                continue
            sure = (int(np.searchsorted(at, at[low] + wrong[0], "right")) - 1 - low) // BATCH
            self.steps += sure
            begin = low + sure * BATCH
            end = min(begin + BATCH, stop)
            self._update(lengths[begin:end], found[at[begin]:at[end]], gold[at[begin]:at[end]], guess[at[begin] - at[low]:at[end] - at[low]])
            low, self.ahead = end, max(LEAST, min(sure, AHEAD))
        self.held = [(lengths[stop:], found[at[stop]:], gold[at[stop]:])] if stop < len(lengths) else []
        self.count = len(lengths) - stop

    def _update(self, lengths: np.ndarray, found: np.ndarray, gold: np.ndarray, guess: np.ndarray) -> None:
        weights, n = self.weights, len(self.weights.tags)
        (rows, tags), (other, guessed) = (_rows_of(found, lengths, x, weights.buckets, n) for x in (gold, guess))
        differ = (rows != other) | (tags != guessed)
        for cells, sign in (((rows[differ], tags[differ]), 1.0), ((other[differ], guessed[differ]), -1.0)):
            np.add.at(weights.values, cells, sign)
            np.add.at(self.later, cells, sign * self.steps)
        self.steps += 1

    def result(self) -> pa.RecordBatch:
        self.run(True)
        cells = BLOCK * len(self.weights.tags)
        change = self.weights.values - self.first
        mean = change - self.later / max(self.steps, 1)
        touched = np.flatnonzero(np.abs(change).reshape(-1, cells).sum(1) + np.abs(mean).reshape(-1, cells).sum(1))
        cut = lambda x: pa.array([x[i * BLOCK:(i + 1) * BLOCK].tobytes() for i in touched], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(touched.astype(np.int32)), cut(change), cut(mean)], names=["block", "change", "mean"])


def _epoch(tags: list[str], buckets: int, sent):
    """One pass of each shard over its sentences: by block, the change of the weights and the change
    of their mean."""
    wide = np.dtype(np.uint16 if buckets <= 1 << 16 else np.uint32)

    def per_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(tags)}
        name, shard = None, None
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "lengths", "found", "gold", "names")]
            for i in range(batch.num_rows):
                of, lengths, found, gold, names = (c[i].as_py() for c in columns)
                if of != name:
                    if shard is not None:
                        yield shard.result()
                    name, shard = of, _Shard(tags, buckets, sent.value)
                codes = np.array([number[x] for x in names], np.int64)
                shard.add(np.frombuffer(lengths, np.int32).astype(np.int64), np.frombuffer(found, wide).reshape(-1, TEMPLATES), codes[np.frombuffer(gold, np.uint16)])
        if shard is not None:
            yield shard.result()
        give_back()

    return per_shard


def _mixed(tags: int):
    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = [sum(np.frombuffer(x) for x in part[c]) for c in ("change", "mean")]
        return pd.DataFrame({"block": part["block"].iloc[:1], "change": [total[0].tobytes()], "mean": [total[1].tobytes()]})

    return add


class TrainedTagger:
    """Tags comments by a trained model; the model is fixed in size and sent to a worker once."""

    def __init__(self, weights: Weights):
        self.weights = weights

    def _guesses(self, df: DataFrame) -> Callable[[pa.Array], Iterator[tuple[int, pa.ListArray, np.ndarray]]]:
        """From an array of token lists, block by block, the first row, the lists and the numbers of all
        their tags."""
        tags, buckets = self.weights.tags, self.weights.buckets
        sent = df.sparkSession.sparkContext.broadcast(self.weights.values)

        def guesses(tokens: pa.Array) -> Iterator[tuple[int, pa.ListArray, np.ndarray]]:
            weights, row = Weights(tags, buckets, sent.value), 0
            for (lists,) in list_blocks([tokens], 0, BLOCK_TOKENS):
                lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                yield row, lists, weights.decode(features(lists.flatten(), lengths, buckets), lengths)
                row += len(lists)

        return guesses

    def tag(self, df: DataFrame, text: str) -> DataFrame:
        """Rows with text, with their ``token`` and ``ner`` arrays."""
        tags, guesses = self.weights.tags, self._guesses(df)

        def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            names = pa.array(tags)
            for batch in batches:
                for _, lists, guess in guesses(batch):
                    offsets = lists.offsets.to_numpy()
                    yield pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), names.take(pa.array(guess)))
            give_back()

        rows = df.where(T.has_text(text)).select("*", F.explode(F.array(name_tokens(text))).alias("token"))
        return rows.withColumn("ner", F.arrow_udf(find, "array<string>")("token"))

    def mentions(self, df: DataFrame, text: str) -> DataFrame:
        """As ``entity_mentions`` of the tagged rows. Only what is tagged comes back, and the texts are
        tagged once: an exploded column would be computed again to see whether it is empty."""
        tags, guesses = self.weights.tags, self._guesses(df)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, plain = pa.array(tags, pa.string()), tags.index("O") if "O" in tags else -1
            for batch in batches:
                for low, lists, guess in guesses(batch.column("token")):
                    offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
                    hit = np.flatnonzero(guess != plain)
                    row = np.searchsorted(offsets, hit, "right") - 1
                    of = pa.array(low + row)
                    columns = [batch.column(0).take(of), batch.column(1).take(of), pa.array(hit - offsets[row]), lists.flatten().take(pa.array(hit)), names.take(pa.array(guess[hit]))]
                    yield pa.RecordBatch.from_arrays(columns, names=[KEY, SEQ, "pos", "token", "ner"])
            give_back()

        rows = df.where(T.has_text(text)).select(KEY, SEQ, name_tokens(text).alias("token"))
        schema = StructType([*rows.schema.fields[:2], StructField("pos", LongType(), False), StructField("token", StringType()), StructField("ner", StringType())])
        return rows.mapInArrow(find, schema).select(KEY, SEQ, "pos", F.lower("token").alias("text"), T.tag_type(F.col("ner")).alias("type"))

    def save(self, spark: SparkSession, path: str) -> None:
        """The model as a small table, a row for each block of buckets in use."""
        tags, values = self.weights.tags, self.weights.values.reshape(-1, BLOCK * len(self.weights.tags))
        used = np.flatnonzero(np.abs(values).sum(1))
        rows = [(int(i), self.weights.buckets, tags, values[i].tobytes()) for i in used] or [(0, self.weights.buckets, tags, values[0].tobytes())]
        spark.createDataFrame(rows, "block int, buckets int, tags array<string>, weights binary").write.mode("overwrite").parquet(path)


def load_tagger(spark: SparkSession, path: str) -> TrainedTagger:
    rows = spark.read.parquet(path).collect()  # as many rows as blocks, a fixed number
    weights = Weights(list(rows[0]["tags"]), rows[0]["buckets"])
    flat = weights.values.reshape(-1, BLOCK * len(weights.tags))
    for row in rows:
        flat[row["block"]] = np.frombuffer(row["weights"])
    return TrainedTagger(weights)


def train_tagger(
    sentences: DataFrame, epochs: int = 5, shards: int = 8, buckets: int = BUCKETS
) -> TrainedTagger:
    """Train on rows of parallel ``token`` and ``ner`` arrays (BIO tags, NULL for ``O``).

    Rows go to shards by their content, so that a second training gives the same model. Sentences
    whose arrays differ in length, or whose tags break the BIO order, are left out.
    """
    tagged = sentences.select("token", F.explode(F.array(F.transform("ner", lambda t: F.coalesce(t, F.lit("O"))))).alias("ner"))
    tagged = tagged.where((F.size("token") == F.size("ner")) & (F.size("token") > 0))
    broken = F.expr("exists(sequence(0, size(ner) - 1), i -> ner[i] like 'I-%' and (i = 0 or substr(ner[i - 1], 3) <> substr(ner[i], 3) or ner[i - 1] = 'O'))")
    code = F.xxhash64("token", "ner")
    rows = tagged.where(~broken).select("token", "ner", F.pmod(code, F.lit(shards)).cast("int").alias("shard"), code.alias("_order"))
    rows = stored(rows.mapInArrow(_prepared(buckets), "shard int, _order long, lengths binary, found binary, gold binary, names array<string>"), "sentences")
    tags = sorted({"O", *(r[0] for r in rows.select(F.explode("names")).distinct().collect())})
    tags = sorted({*tags, *("I-" + t[2:] for t in tags if t.startswith("B-"))})
    names = [r[0] for r in rows.select("shard").distinct().collect()]
    # A partition for each shard, sorted once for all epochs.
    ordered = kept(rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "_order"))
    mixed, mean = Weights(tags, buckets).values, Weights(tags, buckets).values
    for _ in range(epochs):
        sent = rows.sparkSession.sparkContext.broadcast(mixed)
        schema = "block int, change binary, mean binary"
        parts = ordered.mapInArrow(_epoch(tags, buckets, sent), schema)
        summed = parts.groupBy("block").applyInPandas(_mixed(len(tags)), schema).toPandas()  # a row for each block, a fixed number
        mean += mixed / epochs
        mixed = mixed.copy()
        for block, change, average in summed.itertuples(index=False):
            here = slice(block * BLOCK, (block + 1) * BLOCK)
            mixed[here] += np.frombuffer(change).reshape(BLOCK, -1) / max(len(names), 1)
            mean[here] += np.frombuffer(average).reshape(BLOCK, -1) / max(len(names), 1) / epochs
    ordered.unpersist()
    return TrainedTagger(Weights(tags, buckets, mean))
