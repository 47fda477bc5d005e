"""Phrases of several tokens in comments: longest matches of a dictionary."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.automaton import TokenAutomaton
from reelgauge.operators.joins import BROADCAST_BYTES, join_lookup, kept, measured_bytes
from reelgauge.session import give_back

#: Tokens that a task looks up at once; one longer list makes a block of its own.
BLOCK_TOKENS = 1 << 18
MATCHES = "array<struct<start:int,size:int,value:int>>"
_MATCH = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("value", pa.int32())]))

# The automata of a Python worker; a dictionary is sent to a worker once and built there once.
_built: dict[str, TokenAutomaton] = {}


def _automaton(name: str, phrases) -> TokenAutomaton:
    if name not in _built:
        _built.clear()
        _built[name] = TokenAutomaton(phrases.value)
    return _built[name]


def list_blocks(columns: pa.RecordBatch | list[pa.Array], by: int | str, limit: int) -> Iterator:
    """The rows of a batch or of parallel arrays in copies whose lists ``by`` hold at most ``limit``
    elements together; one longer list makes a block of its own."""
    sizes = pc.fill_null(pc.list_value_length(columns.column(by) if isinstance(columns, pa.RecordBatch) else columns[by]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    low = 0
    while low < len(sizes):
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
        rows = pa.array(np.arange(low, high))
        yield columns.take(rows) if isinstance(columns, pa.RecordBatch) else [x.take(rows) for x in columns]
        low = high


def _found(automaton: TokenAutomaton, known: pa.Array, lists: pa.Array) -> pa.Array:
    """The matches of each token list. Only runs of tokens that the dictionary has become Python
    lists: no match goes beyond such a run."""
    tokens = lists.flatten()
    hit = np.flatnonzero(pc.is_in(tokens, value_set=known).to_numpy(zero_copy_only=False))
    offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    row = np.searchsorted(offsets, hit, "right") - 1
    words = tokens.take(pa.array(hit)).to_pylist()
    cut = [*np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(row, prepend=-1) != 0)).tolist(), len(words)]
    start, size, value = [], [], []
    for a, b in zip(cut, cut[1:]):
        for s, n, v in automaton.matches(words[a:b]):
            start.append(a + s)
            size.append(n)
            value.append(v)
    at = np.array(start, np.int64)
    count = np.bincount(row[at], minlength=len(lists))
    place = hit[at] - offsets[row[at]]
    columns = [pa.array(place.astype(np.int32)), pa.array(size, pa.int32()), pa.array(value, pa.int32())]
    ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=list(_MATCH.value_type)))


def _inline(df: DataFrame, phrases: list[tuple[list[str], int]], tokens: Column) -> DataFrame:
    sent, name = df.sparkSession.sparkContext.broadcast(phrases), uuid.uuid4().hex

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton(name, sent)
        known = pa.array(sorted({t for words, _ in sent.value for t in words}), pa.string())
        for batch in batches:
            for (lists,) in list_blocks([batch.cast(pa.list_(pa.string()))], 0, BLOCK_TOKENS):
                yield _found(automaton, known, lists)
        give_back()

    return df.withColumn("matches", F.arrow_udf(find, MATCHES)(tokens))


def _joined(df: DataFrame, terms: DataFrame, key: list[str]) -> DataFrame:
    """For a dictionary beyond the broadcast limit: n-grams of the lengths that it has, joined."""
    lengths = sorted(r[0] for r in terms.select(F.size("words")).distinct().collect())
    names = terms.select(F.to_json("words").alias("_gram"), "value")
    grams = None
    for n in lengths:
        starts = F.sequence(F.lit(0), F.size("tokens") - n)
        one = df.where(F.size("tokens") >= n).select(*key, "tokens", F.explode(starts).alias("start"))
        one = one.select(*key, "start", F.lit(n).alias("size"), F.to_json(F.slice("tokens", F.col("start") + 1, n)).alias("_gram"))
        grams = one if grams is None else grams.unionByName(one)
    if grams is None:
        return df.withColumn("matches", F.array().cast(MATCHES))
    hit = join_lookup(grams, names, "_gram").groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("start", (-F.col("size")).alias("less"), "value"))).alias("_all")
    )
    # From left to right, the longest first; what begins inside a match is passed over.
    fold = f"""aggregate(_all, named_struct('free', 0, 'out', cast(array() as {MATCHES})),
        (a, x) -> if(x.start < a.free, a, named_struct('free', x.start - x.less,
            'out', concat(a.out, array(named_struct('start', x.start, 'size', -x.less, 'value', x.value))))),
        a -> a.out)"""
    named = hit.select(*[F.col(k).alias(f"_{k}") for k in key], F.expr(fold).alias("_found"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    found = df.join(named, same, "left").drop(*[f"_{k}" for k in key])
    return found.withColumn("matches", F.coalesce("_found", F.array().cast(MATCHES))).drop("_found")


def longest_matches(
    df: DataFrame, terms: DataFrame, key: list[str], limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``matches`` (start, size, value) to rows with a ``tokens`` array.

    ``terms`` are distinct ``words array<string>`` with an int ``value``. Up to the limit, as
    measured, the dictionary becomes an automaton in each worker: no token is exploded or
    shuffled. A larger one is joined by n-grams, with the same result; ``key`` then tells the
    rows apart.
    """
    usable = kept(terms.where(F.size("words") > 0))
    if measured_bytes(usable) > limit_bytes:
        return _joined(df, usable, key)
    phrases = [(list(r["words"]), r["value"]) for r in usable.collect()]
    return _inline(df, phrases, F.col("tokens"))
