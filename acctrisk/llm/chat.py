"""Dialogues rendered from every participant's point of view, with DataFrame functions only.

For each participant the dialogue is written out with that participant as the assistant and all
others as named users. What the assistant says is what a model trains on; the mask tells where
it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctrisk.llm.common import materialise

SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>"
SALTS = 16
# Characters of a text by which turns alike in all else are dealt over tasks in order.
HEAD = 1024
# Numbers of rows within a task, as monotonically_increasing_id counts them.
TASK_BITS = 33


def plain(text: Column) -> Column:
    """A text in which nothing reads as a marker of the format; null counts as empty.

    Every `<|` becomes `< |`, which cannot be told from one that stood in the text.
    """
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def name_of(speaker: Column) -> Column:
    """A speaker's name with only letters, digits, `_` and `-`; others become `_`."""
    return F.regexp_replace(F.coalesce(speaker, F.lit("unknown")), "[^A-Za-z0-9_-]", "_")


def participants(turns: DataFrame, system: str = SYSTEM) -> DataFrame:
    """conv_id and perspective: everyone who speaks in a dialogue, the system and nulls apart."""
    spoken = turns.where(F.col("role").isNotNull() & (F.col("role") != system))
    return spoken.select("conv_id", F.col("role").alias("perspective")).distinct()


def in_order(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and place, which ascends in the order of a dialogue; written once.

    The turns are range sorted, so no task gets more than its range, whatever the dialogue or the
    turn number. Equal rows are dealt over tasks by a number of their own.
    """
    keys = ["conv_id", "turn", "role"]
    rows = turns.select(*keys, "text", F.monotonically_increasing_id().alias("_row"))
    order = [*keys, F.left("text", F.lit(HEAD)), F.xxhash64("text"), "_row"]
    return materialise(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*keys, "text", F.monotonically_increasing_id().alias("place")))


def _head(role: Column, name: Column) -> Column:
    return F.concat(F.lit(START), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")),
                    F.lit("\n"))


def rotate(turns: DataFrame, system: str = SYSTEM) -> DataFrame:
    """One row per dialogue, perspective and turn; in order of `start` they make up the dialogue.

    turns: conv_id, turn, role (the speaker) and text; other columns are ignored. Result: conv_id,
    perspective, turn, role (system, user or assistant), name (of a user, else null), rendered,
    start (characters of the dialogue before this turn), mask_start and mask_length (the characters
    of `rendered` to train on: the assistant's text and its end marker; length 0 for others).

    Turns come in the order of turn (null first), role and text (those alike in their first 1024
    characters by a hash); repeated rows are all rendered. A null role is a user called unknown
    without a perspective, a null text an empty one, and rows without conv_id make up one dialogue.
    A dialogue with the system alone has no perspective and gives no rows.

    A dialogue may hold a large share of all rows, and so may one turn number: the turns are range
    sorted and numbered, positions are sums within a dialogue's slices of the sorted tasks and over
    these slices. The perspectives meet salted turns that carry lengths only; a text travels once
    to be sorted and once to where its renderings are put out.
    """
    placed = in_order(turns)
    of_system = F.coalesce(F.col("role") == system, F.lit(False))
    said = F.concat(plain(F.col("text")), F.lit(END))
    other = F.when(of_system, "system").otherwise("user")
    name = F.when(~of_system, name_of(F.col("role")))
    own_head, other_head = _head(F.lit("assistant"), F.lit(None)), _head(other, name)

    sizes = placed.select(
        "conv_id", "role", "place", F.shiftright("place", TASK_BITS).alias("_slice"),
        F.pmod("place", F.lit(SALTS)).cast("int").alias("_salt"),
        (F.length(own_head) + F.length(said) + 1).alias("_own_length"),
        (F.length(other_head) + F.length(said) + 1).alias("_other_length"))
    seen = participants(placed, system).select(
        F.col("conv_id").alias("_conv"), "perspective",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_of"))
    own = F.coalesce(F.col("role") == F.col("perspective"), F.lit(False))
    views = sizes.join(seen, sizes.conv_id.eqNullSafe(seen._conv) & (sizes._salt == seen._of))
    views = views.select(
        "conv_id", "perspective", "_slice", "place", own.alias("_own"),
        F.when(own, F.col("_own_length")).otherwise(F.col("_other_length")).alias("_length"))

    view = ["conv_id", "perspective"]
    before = Window.unboundedPreceding, -1
    in_slice = Window.partitionBy(*view, "_slice").orderBy("place").rowsBetween(*before)
    of_slices = Window.partitionBy(*view).orderBy("_slice").rowsBetween(*before)
    slices = views.groupBy(*view, "_slice").agg(F.sum("_length").alias("_length")).select(
        F.col("conv_id").alias("_conv"), F.col("perspective").alias("_view"),
        F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_length").over(of_slices), F.lit(0)).alias("_base"))
    views = views.withColumn("_inner", F.coalesce(F.sum("_length").over(in_slice), F.lit(0)))
    same = (views.conv_id.eqNullSafe(slices._conv) & (views.perspective == slices._view)
            & (views._slice == slices._at))
    starts = views.join(slices, same).select(
        "place", "perspective", "_own", (F.col("_base") + F.col("_inner")).alias("start"))

    role = F.when(F.col("_own"), "assistant").otherwise(other)
    head = F.when(F.col("_own"), own_head).otherwise(other_head)
    return starts.join(placed, "place").select(
        *view, "turn", role.alias("role"), F.when(~F.col("_own"), name).alias("name"),
        F.concat(head, said, F.lit("\n")).alias("rendered"), "start",
        F.length(head).alias("mask_start"),
        F.when(F.col("_own"), F.length(said)).otherwise(F.lit(0)).alias("mask_length"))
