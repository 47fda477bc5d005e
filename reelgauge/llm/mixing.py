"""Mixing sources to target weights by systematic sampling.

A document's expected number of copies is what its source still has to take over the size of its
documents still to come. The expected copies are summed along the source, one random offset is added
to all sums, and a document is emitted once for each integer that its step crosses.

The order inside a source goes by size class, the largest first, and all documents of a class have
the same expected copies: what whole copies of large documents take too much or too little, by the
counts of the classes, the smaller ones make good. The sum inside a class is a rank times the step,
and the rank comes from counts of blocks (class, salt) and a number inside the block: a hot source,
and a hot size as that of many copies, lies in many blocks.

All of it is DataFrame expressions. Defined cases: null source is a source of its own, the last; a
null or empty text has size 0; a source of size 0 has target 0 and takes nothing; repeated rows count
one by one; an empty table gives no rows. Columns besides doc_id, text and source are not read,
except by ``mixed``, which keeps all columns; its own begin with ``_mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.operators.joins import join_lookup

from .common import saved, word_count

#: Most copies of a document, and with it the cap of a target over its source's size.
MOST = 3
#: Weights of the sources in code-point order, repeated.
WEIGHTS = (1, 2, 3)
#: Salts that a size class is dealt over.
SALTS = 64
SEED = "mix"


def _number(c: Column, digits: int) -> Column:
    """A number from the first hex digits of a digest."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(SEED), c)), 1, digits), 16, 10).cast("long")


def _size_class(size: Column) -> Column:
    """The size's bit length and the three bits after the first."""
    length = F.length(F.bin(size))
    return (length * 8 + F.expr("shiftright(_mix_size, greatest(length(bin(_mix_size)) - 4, 0)) & 7")).cast("int")


def key_of(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), column), F.lit(""))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target: 100 % of all sizes shared by weight, no target above ``most``
    times its source's size. ``sizes`` holds one row for each source (source, source_size).

    Sources reach their caps in the order of cap over weight. The level is that of the first source,
    in this order, whose cap lies above what the rest would get for its weight.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(in_order) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    rest = ranked.select(
        "*",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("open_words"),
        F.sum("weight").over(after).alias("open_weight"),
    ).withColumn("fits", F.col("open_words") * F.col("weight") <= F.col("cap") * F.col("open_weight"))
    level = F.min(F.when(F.col("fits"), F.struct((F.col("cap") / F.col("weight")).alias("at"), F.col("source").isNull().alias("last"), "source", "open_words", "open_weight"))).over(every)
    return rest.withColumn("level", level).select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level.open_words") / F.col("level.open_weight")).alias("target"),
    )


def _with_copies(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``rows`` with _mix_source_size, _mix_target and _mix_copies; they hold _mix_id, _mix_source
    and _mix_size."""
    size = F.col("_mix_size")
    dealt = rows.select("*", key_of("_mix_source").alias("_mix_key"), _size_class(size).alias("_mix_class"), (_number(F.coalesce(F.col("_mix_id").cast("string"), F.lit("")), 12) % SALTS).alias("_mix_salt"))
    block = ["_mix_key", "_mix_class", "_mix_salt"]
    per_block = saved(dealt.groupBy(*block).agg(F.first("_mix_source").alias("_mix_source"), F.count("*").alias("n"), F.sum("_mix_size").alias("words")), "mix-blocks")
    sizes = per_block.groupBy("_mix_key").agg(F.first("_mix_source").alias("source"), F.sum("words").alias("source_size"))
    goal = targets(sizes.select("source", "source_size"), weights, most)
    earlier = Window.partitionBy("_mix_key", "_mix_class").orderBy("_mix_salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_block.select(*block, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_mix_shift"))
    per_class = per_block.groupBy("_mix_key", "_mix_class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    lookup = shift.join(_steps(per_class, goal, most), ["_mix_key", "_mix_class"])
    inside = Window.partitionBy(*block).orderBy("_mix_size", "_mix_id")
    numbered = join_lookup(dealt.withColumn("_mix_nth", F.row_number().over(inside)), lookup, block)
    rank = F.col("_mix_nth") + F.col("_mix_shift")
    until = lambda r: F.floor(F.col("_mix_base") + r * F.col("_mix_step") + F.col("_mix_offset"))
    return numbered.withColumn("_mix_copies", (until(rank) - until(rank - 1)).cast("int"))


def _steps(per_class: DataFrame, goal: DataFrame, most: int) -> DataFrame:
    """The expected copies of each class's documents, and the sum of those before the class. A
    source has a few hundred classes whatever its size."""
    classes = per_class.groupBy("_mix_key").agg(F.reverse(F.array_sort(F.collect_list(F.struct("_mix_class", "n", "words")))).alias("classes"))
    rate = goal.select(key_of("source").alias("_mix_key"), F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"))
    state = classes.join(rate, "_mix_key").withColumn("_mix_offset", _number(F.col("_mix_key"), 12) / F.lit(float(1 << 48)))
    step = f"if(a.left > 0, least({float(most)}D, greatest(0D, a.want / a.left)), 0D)"
    fold = f"""aggregate(classes,
        named_struct('want', _mix_target, 'left', _mix_source_size, 'sum', 0D, 'done', cast(array() as array<struct<class: int, base: double, step: double>>)),
        (a, x) -> named_struct(
            'want', a.want - (floor(a.sum + x.n * {step} + _mix_offset) - floor(a.sum + _mix_offset)) * (x.words / x.n),
            'left', a.left - x.words,
            'sum', a.sum + x.n * {step},
            'done', concat(a.done, array(named_struct('class', x._mix_class, 'base', a.sum, 'step', {step})))),
        a -> a.done)"""
    return state.select("_mix_key", "_mix_offset", "_mix_source_size", "_mix_target", F.explode(F.expr(fold)).alias("c")).select("_mix_key", "_mix_offset", "_mix_source_size", "_mix_target", F.col("c.class").alias("_mix_class"), F.col("c.base").alias("_mix_base"), F.col("c.step").alias("_mix_step"))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row for each document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("_mix_id"), F.col("source").cast("string").alias("_mix_source"), word_count(F.col("text").cast("string")).alias("_mix_size"))
    found = _with_copies(saved(narrow, "mix-sizes"), weights, most)
    return found.select(
        F.col("_mix_id").alias("doc_id"), F.col("_mix_source").alias("source"), F.col("_mix_size").alias("size"),
        F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        F.col("_mix_copies").alias("copies"), (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents, each as often as the mix takes it, with all their columns."""
    sized = docs.select("*", F.col("doc_id").cast("long").alias("_mix_id"), F.col("source").cast("string").alias("_mix_source"), word_count(F.col("text").cast("string")).alias("_mix_size"))
    found = _with_copies(sized, weights, most).where("_mix_copies > 0")
    return found.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*[found[f"`{c}`"] for c in docs.columns])
