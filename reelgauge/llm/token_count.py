"""Token counts by a tokenizer compiled into finite-state transducers.

A byte-level BPE tokenizer is the composition of two deterministic machines. The first reads
characters and marks where a piece begins; it looks one character back and ahead. The second reads
bytes and adds to a count: after each byte the count is that of the tokens of the piece so far, so
that a transition carries a number that may also be below zero, when tokens merge.

The second machine's state holds what later tokens depend on: the starts from which a token may yet
reach beyond the last byte, each with the token that ends there and its count. A token may follow
another where the library, given both texts together, returns just these two. States and transitions
are made when a text first needs them and kept for the worker's later tasks; beyond ``limit`` states
the machine starts anew, which changes no result.

Texts are cut into chunks that run side by side. A chunk that holds the beginning of a piece maps
every state to the same one from there on; only its bytes before that depend on the chunk before. A
chunk without one is a map of the states that can be live at its start: the end states of the chunk
before, first taken as read from the initial state, until no new ones come up. Equal chunks share their
map. The maps of such chunks are composed by a parallel prefix scan, in as many rounds as the
logarithm of their number.

Defined cases: null is the empty text with 0 tokens; a special token's string in a text counts as the
library counts it, as one token that pieces do not cross; rows that repeat a doc_id are counted one
by one; an empty table gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, flat, sums, texts_of, tokenizer

CHUNK = 512
LETTER, DIGIT, SPACE, BLANK, OTHER = range(5)  # BLANK: white space that is not U+0020
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@cache
def _byte_names() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: its own where that
    is printable in Latin-1, else the next one from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Pieces:
    """The first machine: where pieces begin."""

    def __init__(self, path: str):
        self.library = tokenizer(path).pre_tokenizer
        self.known = np.full(0x110000, 255, np.uint8)

    def _learn(self, codes: np.ndarray) -> None:
        """Ask the library how it splits each character from a letter, a digit and a mark."""
        for c in codes.tolist():
            x = chr(c)
            joins = lambda s: len(self.library.pre_tokenize_str(s)) == 1
            kind = SPACE if c == 32 else LETTER if joins(f"a{x}") else DIGIT if joins(f"1{x}") else OTHER if joins(f"!{x}") else BLANK
            self.known[c] = kind

    def begin(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each character whether a piece begins there; ``starts``: where texts begin, and the
        end of the last."""
        if not len(codes):
            return np.zeros(0, bool)
        kind = self.known[codes]
        if (kind == 255).any():
            self._learn(np.unique(codes[kind == 255]))
            kind = self.known[codes]
        first = np.zeros(len(codes) + 1, bool)
        first[starts[:-1]] = True
        last = np.append(first[1:-1], True)
        first = first[:-1]
        white = (kind == SPACE) | (kind == BLANK)
        before = np.append(OTHER, kind[:-1])
        white_before = np.append(False, white[:-1]) & ~first
        white_after = np.append(white[1:], False) | last  # the end of a text ends no run early
        # White space: a run is one piece but for its last character where text follows.
        begin = np.where(white, ~white_before | ~white_after, np.where(white_before, before != SPACE, kind != before))
        begin |= first
        for at in np.flatnonzero(begin & (codes == 39)).tolist():
            after = codes[at + 1:at + 3]
            room = int(starts[np.searchsorted(starts, at, "right")]) - at - 1
            word = "".join(map(chr, after[:room]))
            taken = next((len(c) for c in _CONTRACTIONS if word.startswith(c)), 0)
            if taken:
                begin[at + 1:at + 1 + taken] = False
                if taken < room:
                    begin[at + 1 + taken] = True
        return begin


class Counter:
    """The second machine, compiled as far as texts have needed it."""

    def __init__(self, path: str, limit: int = 250_000):
        self.pieces = Pieces(path)
        self.special = re.compile("|".join(re.escape(t.content) for t in tokenizer(path).get_added_tokens_decoder().values()) or r"(?!)")
        self.model = tokenizer(path).model
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.names = _byte_names()
        value = {c: b for b, c in enumerate(self.names)}
        self.text: dict[int, str] = {}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for name, token in vocabulary.items():
            if len(name) > 1 and [t.id for t in self.model.tokenize(name)] != [token]:
                continue  # never the result of merges
            self.text[token] = name
            node = 0
            for c in name:
                node = self.children[node].setdefault(value[c], len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token.append(-1)
            self.token[node] = token
        self.follows: dict[tuple[int, int], bool] = {}
        self.limit = limit
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.used = 0
        self.grow(19)

    def grow(self, bits: int) -> None:
        """A table of the transitions, found by hash of state and byte, with room for more."""
        old = getattr(self, "key", np.zeros(0, np.int64)) if self.used else np.zeros(0, np.int64)
        held = np.flatnonzero(old >= 0)
        kept = [(int(old[i]), int(self.to[i]), int(self.add[i])) for i in held]
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.key = np.full(1 << bits, -1, np.int64)
        self.to = np.zeros(1 << bits, np.int32)
        self.add = np.zeros(1 << bits, np.int8)
        self.used = 0
        for transition in kept:
            self.put(*transition)

    def slot(self, key: np.ndarray) -> np.ndarray:
        """Where each key lies, or the free place that ends its search."""
        at = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        found = self.key[at]
        other = np.flatnonzero((found != key) & (found >= 0))
        while len(other):
            at[other] = (at[other] + 1) & self.mask
            found = self.key[at[other]]
            other = other[(found != key[other]) & (found >= 0)]
        return at

    def put(self, key: int, to: int, add: int) -> None:
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while self.key[at] >= 0:
            at = (at + 1) & self.mask
        self.key[at], self.to[at], self.add[at] = key, to, add
        self.used += 1

    def may_follow(self, a: int, b: int) -> bool:
        found = self.follows.get((a, b))
        if found is None:
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            found = self.follows[a, b] = a < 0 or [t.id for t in self.model.tokenize(self.text[a] + self.text[b])] == [a, b]
        return found

    def compile(self, state: int, byte: int) -> None:
        """Make one transition."""
        kept, token, added = [], -1, 0
        for node, before, count in self.states[state]:
            node = self.children[node].get(byte)
            if node is None:
                continue
            ends = self.token[node]
            if token < 0 and ends >= 0 and self.may_follow(before, ends):
                token, added = ends, count + 1
            if self.children[node]:
                kept.append((node, before, count))
        reached = (*((n, t, c - added) for n, t, c in kept), (0, token, 0))
        to = self.number.setdefault(reached, len(self.states))
        if to == len(self.states):
            self.states.append(reached)
        if 3 * self.used > self.mask:
            self.grow(self.mask.bit_length() + 1)
        self.put(state << 8 | byte, to, added)

    def run(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read symbols[low:high] of every lane, side by side; the states and what they added. A
        symbol is a byte, and 256 more where a piece begins."""
        count = np.zeros(len(low), np.int64)
        order = np.argsort(low - high, kind="stable")  # the longest first
        low, length, state = low[order], (high - low)[order], state[order].astype(np.int64)
        most = int(length[0]) if len(length) else 0
        # Row i holds the i-th symbol of every lane; what lies past a lane's end is not read.
        rows = np.ascontiguousarray(symbols[np.minimum(low[:, None] + np.arange(most), len(symbols) - 1)].T)
        alive = np.searchsorted(-length, -np.arange(most), "left")
        for i in range(most):
            n = alive[i]
            symbol = rows[i, :n].astype(np.int64)
            key = np.where(symbol > 255, symbol - 256, state[:n] << 8 | symbol)
            at = self.slot(key)
            if (new := self.key[at] < 0).any():
                for c in np.unique(key[new]).tolist():
                    self.compile(c >> 8, c & 255)
                at = self.slot(key)
            state[:n] = self.to[at]
            count[:n] += self.add[at]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """The tokens of each text."""
        if len(self.states) > self.limit:
            self.reset()
        plain, owner, extra = texts, np.arange(len(texts)), np.zeros(len(texts), np.int64)
        if any(b"<|" in x for x in texts):
            split = [self.special.split(x.decode()) for x in texts]
            extra = np.array([len(x) - 1 for x in split], np.int64)
            plain = [y.encode() for x in split for y in x]
            owner = np.repeat(np.arange(len(texts)), [len(x) for x in split])
        return extra + np.bincount(owner, weights=self._plain(plain), minlength=len(texts)).astype(np.int64)

    def _scanned(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray, state: int) -> tuple[list[int], list[int]]:
        """States and counts after each of some neighbouring chunks without a beginning of a piece,
        the first of which is entered in ``state``."""
        index: dict[bytes, int] = {}
        kind = [index.setdefault(symbols[a:b].tobytes(), len(index)) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        place = {k: i for i, k in reversed(list(enumerate(kind)))}
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def learn(pairs: set[tuple[int, int]]) -> None:
            new = sorted(pairs - known.keys())
            if new:
                rows = np.array([place[k] for k, _ in new])
                reached, added = self.run(symbols, low[rows], high[rows], np.array([s for _, s in new], np.int64))
                known.update(zip(new, zip(reached.tolist(), added.tolist(), strict=True), strict=True))

        learn({(k, 0) for k in kind})
        live = [{state}, *({known[k, 0][0]} for k in kind[:-1])]
        open_ = [(i, s) for i, states in enumerate(live) for s in states]
        while open_:
            learn({(kind[i], s) for i, s in open_})
            reached = {(i + 1, known[kind[i], s][0]) for i, s in open_ if i + 1 < len(kind)}
            open_ = [(i, s) for i, s in reached if s not in live[i]]
            for i, s in open_:
                live[i].add(s)
        maps = [{s: known[k, s] for s in states} for k, states in zip(kind, live, strict=True)]
        apart = 1
        while apart < len(maps):
            maps = maps[:apart] + [
                {s: (after[mid][0], n + after[mid][1]) for s, (mid, n) in before.items()}
                for before, after in zip(maps, maps[apart:])
            ]
            apart *= 2
        through = [m[state] for m in maps]
        totals = [n for _, n in through]
        return [s for s, _ in through], [b - a for a, b in zip([0, *totals], totals)]

    def _plain(self, texts: list[bytes]) -> np.ndarray:
        data, starts = flat(texts)
        lead = (data & 0xC0) != 0x80
        place = np.flatnonzero(lead)
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        begin = np.zeros(len(data), bool)
        begin[place] = self.pieces.begin(codes, np.searchsorted(place, starts))
        # Chunks never cross texts; the first byte of a text always begins a piece.
        sizes = np.diff(starts)
        per_text = -(-sizes // CHUNK)
        text = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        low = starts[text] + nth * CHUNK
        high = np.minimum(low + CHUNK, starts[text + 1])
        marks = np.flatnonzero(begin)
        fixed = marks[np.minimum(np.searchsorted(marks, low), len(marks) - 1)] if len(marks) else high
        fixed = np.where((fixed >= low) & (fixed < high), fixed, high)
        # A chunk's map: from `fixed` on it is constant; before, it continues the chunk before.
        symbols = data.astype(np.int16) + np.int16(256) * begin
        state, count = self.run(symbols, fixed, high, np.zeros(len(low), np.int64))
        whole = (fixed == high) & (nth > 0)
        ends = np.flatnonzero(whole & ~np.append(whole[1:], False)) + 1
        for first, end in zip(np.flatnonzero(whole & ~np.append(False, whole[:-1])).tolist(), ends.tolist(), strict=True):
            state[first:end], count[first:end] = self._scanned(symbols, low[first:end], high[first:end], int(state[first - 1]))
        ready = np.flatnonzero((fixed > low) & ~whole)
        _, more = self.run(symbols, low[ready], fixed[ready], state[ready - 1])
        count[ready] += more
        return sums(count, np.append(0, np.cumsum(per_text)))


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, most: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``most`` tokens)."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(tokenizer_path)
        for block in blocks(batches):
            texts = texts_of(block)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(sizes), pa.array(machine.counts(texts))], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(per_batch, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > most)
