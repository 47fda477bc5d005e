"""Preference formatting: the common turns of a chosen and a rejected conversation once as prompt,
what follows them as a pair of masked completions.

Both conversations are rows (pair_id, turn, role, text). The result keeps one row for each rendered
turn, so that a conversation of any length stays spread over the cluster; ``as_text`` joins them. The
longest common prefix ends before the first turn on which the two sides differ, which is a minimum
over rows and needs no order inside a group.

Defined cases: null role and text are rendered as empty; a null turn comes last; repeated rows count
once; rows that share a turn are ordered by role and text and differ as a whole; equal sides give a
prompt and no completion; a pair that only one side has gets an empty prompt and one completion; empty
tables give no rows. Columns besides the four are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

LAST = (1 << 63) - 1
TURN = ["pair_id", "turn", "role", "text"]


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("pair_id").cast("long"), F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def preference_turns(chosen: DataFrame, rejected: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), turn, role, rendered, loss_from, loss_to.

    A completion's loss covers the characters from loss_from up to loss_to of ``rendered``: the
    text and line end of turns by ``trained_role``. Everything else has an empty span.
    """
    sides = _turns(chosen).withColumn("side", F.lit(1)).unionByName(_turns(rejected).withColumn("side", F.lit(2)))
    merged = saved(sides.groupBy(*TURN).agg(F.max((F.col("side") == 1)).alias("in_chosen"), F.max((F.col("side") == 2)).alias("in_rejected")), "preference-turns")
    differs = merged.groupBy(F.col("pair_id").alias("pair")).agg(F.min(F.when(~(F.col("in_chosen") & F.col("in_rejected")), F.col("turn"))).alias("from_turn")).where("from_turn is not null")
    placed = merged.join(differs, F.col("pair_id").eqNullSafe(F.col("pair")), "left")
    common = F.col("from_turn").isNull() | (F.col("turn") < F.col("from_turn"))
    parts = F.when(common, F.array(F.lit("prompt"))).otherwise(F.filter(F.array(F.when(F.col("in_chosen"), F.lit("chosen")), F.when(F.col("in_rejected"), F.lit("rejected"))), lambda x: x.isNotNull()))
    rendered = F.concat(header(F.col("role")), "text", F.lit("\n"))
    trained = (F.col("role") == trained_role) & (F.col("part") != "prompt")
    return placed.withColumn("part", F.explode(parts)).select(
        "pair_id", "part", "turn", "role", rendered.alias("rendered"),
        F.when(trained, F.length(header(F.col("role")))).otherwise(0).cast("int").alias("loss_from"),
        F.when(trained, F.length(rendered)).otherwise(0).cast("int").alias("loss_to"),
    )


def as_text(turns: DataFrame) -> DataFrame:
    """pair_id, part, text, loss (spans in the joined text): for conversations that fit a row."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "rendered", "loss_from", "loss_to")))
    grouped = turns.groupBy("pair_id", "part").agg(ordered.alias("all"))
    spans = F.expr(
        "filter(transform(sequence(1, size(all)), i -> named_struct("
        "'low', aggregate(slice(all, 1, i - 1), 0, (a, x) -> a + length(x.rendered)) + all[i - 1].loss_from, "
        "'high', aggregate(slice(all, 1, i - 1), 0, (a, x) -> a + length(x.rendered)) + all[i - 1].loss_to)), x -> x.high > x.low)"
    )
    return grouped.select("pair_id", "part", F.concat_ws("", F.col("all.rendered")).alias("text"), spans.alias("loss"))


def repeated_answer_pairs(conversations: DataFrame, role: str = "assistant") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides from plain conversations (conv_id, turn, role, text): each as it is,
    and the same with the answer before in place of its last one (empty if there is none). Turns
    after the last answer stay on both sides. A conversation without an answer is the same on
    both."""
    turns = _turns(conversations.withColumnRenamed("conv_id", "pair_id"))
    answers = turns.where(F.col("role") == role)
    last = answers.groupBy(F.col("pair_id").alias("pair")).agg(F.max("turn").alias("last"))
    same = F.col("pair_id").eqNullSafe(F.col("pair"))
    earlier = answers.join(last, same).where("turn < last").groupBy(F.col("pair").alias("pair_2")).agg(F.max(F.struct("turn", "text")).alias("before"))
    known = last.join(earlier, F.col("pair").eqNullSafe(F.col("pair_2")), "left").select("pair", "last", F.coalesce("before.text", F.lit("")).alias("instead"))
    chosen = turns.join(known, same, "left")
    replaced = F.coalesce((F.col("turn") == F.col("last")) & (F.col("role") == role), F.lit(False))
    rejected = chosen.withColumn("text", F.when(replaced, F.col("instead")).otherwise(F.col("text")))
    return chosen.select(*TURN), rejected.select(*TURN)
