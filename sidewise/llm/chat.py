"""Perspective rotation: every participant of a dialogue becomes the assistant once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Turn numbers that one running sum covers; totals of such blocks are summed on their own.
TURNS_PER_BLOCK = 64


def rotations(turns: DataFrame, system: str = "system", unknown: str = "unknown") -> DataFrame:
    """One row per participant and turn: the turn as that participant's training text shows it.

    The rows of a (conv_id, perspective), concatenated by ``seq``, are the whole
    rendering.  The perspective's own turns are headed "assistant", all others "user"
    with the speaker's name, system turns stay system turns and are no participant.
    ``start`` is the offset of the row in the rendering (code points); the mask of the
    loss is mask_start to mask_end (exclusive: text and closing marker of own turns,
    null for others).

    Long dialogues stay split: a hot conversation is many blocks of turns, and only
    block totals are summed along it.  Null roles speak as ``unknown``; null and empty
    texts render as empty turns; null turns come first; turns with the same number are
    ordered by speaker and text, repeated ones all stay.  A conversation without
    participants gives no row, a null conv_id is a conversation of its own.  Markers
    inside a text are broken up, line ends in names become blanks.  Columns other than
    conv_id, turn, role and text are left out.
    """
    c = F.col
    said = turns.select(
        "conv_id", "turn", F.translate(F.coalesce("role", F.lit(unknown)), "\n", " ").alias("speaker"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("body"),
    )
    people = said.where(c("speaker") != system).select(c("conv_id").alias("of"), c("speaker").alias("perspective")).distinct()
    own = c("speaker") == c("perspective")
    head = F.when(c("speaker") == system, F.lit("system")).when(own, F.lit("assistant")).otherwise(
        F.concat(F.lit("user name="), F.replace("speaker", F.lit("<|"), F.lit("< |")))
    )
    rows = said.join(people, c("conv_id").eqNullSafe(c("of"))).select(
        "conv_id", "perspective", "turn", "speaker", F.floor(c("turn") / TURNS_PER_BLOCK).alias("block"), own.alias("trained"),
        F.concat(F.lit(OPEN), head, F.lit("\n")).alias("opening"), "body",
    ).withColumn("rendered", F.concat("opening", "body", F.lit(CLOSE + "\n")))

    length = F.length("rendered").cast("bigint")
    order = [c("turn").asc_nulls_first(), c("speaker"), c("body")]
    block = Window.partitionBy("conv_id", "perspective", "block").orderBy(*order)
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumns({"at": F.coalesce(F.sum(length).over(before), F.lit(0)), "row": F.row_number().over(block)})

    earlier = Window.partitionBy("b_conv", "b_perspective").orderBy(c("b_block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(c("conv_id").alias("b_conv"), c("perspective").alias("b_perspective"), c("block").alias("b_block")).agg(
        F.sum(length).alias("chars"), F.count(F.lit(1)).alias("turns")
    )
    bases = totals.select(
        "b_conv", "b_perspective", "b_block", F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("base"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("rows_before"),
    )
    joined = inside.join(
        bases,
        c("conv_id").eqNullSafe(c("b_conv")) & (c("perspective") == c("b_perspective")) & c("block").eqNullSafe(c("b_block")),
    )
    start = c("base") + c("at")
    mask_start = start + F.length("opening")
    return joined.select(
        "conv_id", "perspective", (c("rows_before") + c("row")).alias("seq"), "turn", "speaker", "trained", "rendered",
        start.alias("start"), F.when(c("trained"), mask_start).alias("mask_start"),
        F.when(c("trained"), mask_start + F.length("body") + len(CLOSE)).alias("mask_end"),
    )
