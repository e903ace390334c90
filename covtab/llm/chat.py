"""Multi-party perspective rotation, in DataFrame operations only.

For every participant of a conversation the whole dialogue is rendered once
more, with that speaker as the assistant and every other one as a named user.
System turns stay system turns in every rendering and have none of their own.
The result has one row for each turn of each rendering, so a rendering is
never gathered in one task however long it is: its segments, in order of
``position``, are the text, and ``start`` and ``end`` are their places in it.
``mask_start`` to ``mask_end`` is what a loss applies to (the assistant's words
and the end marker); elsewhere the two are equal.

Places are running sums in two levels. Turns are cut into blocks of
``BLOCK_TURNS`` turn numbers; blocks are summed first, and each block then
knows where it begins, so a conversation with a third of all turns is spread
over its blocks.

Turns are ordered by turn number (null first), speaker and text. Cases: null
text is empty, a null or empty role speaks as ``UNNAMED``; turns whose conv_id
is null are one conversation, rendered like any other with a null conv_id;
repeated rows are rendered each; a conversation of system turns alone gives no
rows, and so does an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TURNS = 256
SYSTEM_ROLES = ("system",)
UNNAMED = "unnamed"
# The rendering: a head for each kind of turn, and the end marker.
SYSTEM_HEAD = "<|system|>\n"
ASSISTANT_HEAD = "<|assistant|>\n"
USER_HEAD = "<|user name={}|>\n"
END = "<|end|>\n"
# A conversation's key; neither column is ever null, so that joins match it.
_CONV = ["conv", "no_conv"]


def _user_head(speaker: Column) -> Column:
    before, after = USER_HEAD.split("{}")
    return F.concat(F.lit(before), speaker, F.lit(after))


def rotate(conversations: DataFrame, system_roles: tuple[str, ...] = SYSTEM_ROLES,
           block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id``, ``perspective``, ``position`` (from 0), ``turn``,
    ``speaker``, ``segment``, ``start``, ``end``, ``mask_start``, ``mask_end``
    (code points in the whole rendering)."""
    role = F.trim(F.col("role").cast("string"))
    conv = F.col("conv_id").cast("long")
    turns = conversations.select(
        F.coalesce(conv, F.lit(0).cast("long")).alias("conv"), conv.isNull().alias("no_conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(F.length(role) > 0, role).otherwise(UNNAMED).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("words"))
    head = (F.when(F.col("speaker").isin(*system_roles), F.lit(SYSTEM_HEAD))
            .otherwise(_user_head(F.col("speaker"))))
    turns = turns.select(
        "*", F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(1 << 62)))
        .cast("long").alias("block"),
        (F.char_length(head) + F.char_length("words") + len(END)).cast("long").alias("as_other"),
        (len(ASSISTANT_HEAD) - F.char_length(head)).cast("long").alias("more"))

    # Sums of the blocks, by speaker, from narrow rows.
    sums = turns.groupBy(*_CONV, "block", "speaker").agg(
        F.count("*").alias("turns"), F.sum("as_other").alias("as_other"),
        F.sum("more").alias("more"))
    participants = (sums.where(~F.col("speaker").isin(*system_roles))
                    .select(*_CONV, F.col("speaker").alias("perspective")).distinct())
    blocks = sums.groupBy(*_CONV, "block").agg(F.sum("turns").alias("turns"),
                                               F.sum("as_other").alias("as_other"))
    own = sums.select(*_CONV, "block", F.col("speaker").alias("perspective"), "more")
    before = (Window.partitionBy(*_CONV, "perspective").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0).cast("long")
    begins = (blocks.join(participants, _CONV)
              .join(own, [*_CONV, "block", "perspective"], "left")
              .select(*_CONV, "block", "perspective",
                      F.coalesce(F.sum("turns").over(before), zero).alias("first_position"),
                      F.coalesce(F.sum(F.col("as_other") + F.coalesce("more", zero)).over(before),
                                 zero).alias("first_start")))

    mine = F.col("speaker") == F.col("perspective")
    inside = (Window.partitionBy(*_CONV, "block", "perspective")
              .orderBy("turn", "speaker", "words")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    size = F.col("as_other") + F.when(mine, F.col("more")).otherwise(zero)
    placed = (turns.join(begins, [*_CONV, "block"])
              .withColumn("size", size)
              .withColumn("end", F.col("first_start") + F.sum("size").over(inside))
              .withColumn("position", F.col("first_position") + F.count("*").over(inside) - 1))
    segment = F.concat(F.when(mine, F.lit(ASSISTANT_HEAD)).otherwise(head), "words", F.lit(END))
    start = F.col("end") - F.col("size")
    return placed.select(
        F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), "perspective", "position", "turn", "speaker", segment.alias("segment"),
        start.alias("start"), "end",
        F.when(mine, start + len(ASSISTANT_HEAD)).otherwise(F.col("end")).alias("mask_start"),
        F.col("end").alias("mask_end"))
