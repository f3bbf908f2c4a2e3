"""Conversations seen by each of their participants, by perspective rotation.

For every participant the whole dialogue is rendered once with that speaker as the
assistant and all others as named users; only the assistant's turns are trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.ordered import blocks

#: Speakers that set the scene and take no part in it.
CONTEXT = ("system",)
#: The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _header(role: Column, speaker: Column) -> Column:
    named = F.when(role == "user", F.concat(F.lit(" name="), speaker)).otherwise("")
    return F.concat(F.lit(OPEN), role, named, F.lit("\n"))


def rotate(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", context: tuple[str, ...] = CONTEXT
) -> DataFrame:
    """One row per turn and perspective: ``conv_id``, ``perspective``, ``turn``, ``seq``,
    ``speaker``, ``role``, ``rendered``, ``start``, ``end``, ``trained``, ``loss_start``, ``loss_end``.

    Turns are ordered by number (null first), then speaker and text; equal rows
    are turns of their own. ``seq`` numbers them from 0, and the rendered pieces in this
    order make up the dialogue; ``start`` and ``end`` are their places in it, in
    characters. Of a trained turn the text and the closing mark carry loss, from
    ``loss_start`` to ``loss_end``; for other turns both are ``end``. A null speaker is
    the participant "", a null text is empty, a null conversation is one like any
    other. Speakers in ``context`` keep their name as role and have no perspective; a
    conversation of them alone has no rows. Other columns are not carried.

    Places are running sums over blocks of the order, so that one conversation may
    hold any share of all turns.
    """
    said = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker), F.lit("")).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())
    scenery = F.col("speaker").isin(*context) if context else F.lit(False)
    own = said.filter(~scenery).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    seen = said.join(own, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    mine = F.col("speaker") == F.col("perspective")
    seen = seen.withColumn("role", F.when(mine, "assistant").when(scenery, F.col("speaker")).otherwise("user"))
    seen = seen.withColumn("size", F.length(_header(F.col("role"), F.col("speaker"))) + F.length("text") + len(CLOSE))

    dialogue = ["conv_id", "perspective"]
    order = ["turn", "speaker", "text", "row"]
    cut = blocks(seen, *dialogue, *order)
    before = Window.partitionBy("block", *dialogue).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy("block", *dialogue).agg(F.sum("size").alias("chars"), F.count("*").alias("turns"))
    earlier = Window.partitionBy(*dialogue).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        F.col("block").alias("in_block"),
        F.col("conv_id").alias("of"),
        F.col("perspective").alias("by"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns"),
    )
    placed = cut.withColumn("chars_here", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn(
        "turns_here", F.coalesce(F.count("*").over(before), F.lit(0))
    )
    same = (F.col("block") == F.col("in_block")) & F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("perspective") == F.col("by"))
    placed = placed.join(carried, same).withColumn("start", F.col("chars_here") + F.col("chars"))
    trained = F.col("role") == "assistant"
    end = F.col("start") + F.col("size")
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        (F.col("turns_here") + F.col("turns")).alias("seq"),
        "speaker",
        "role",
        F.concat(_header(F.col("role"), F.col("speaker")), F.col("text"), F.lit(CLOSE)).alias("rendered"),
        "start",
        end.alias("end"),
        trained.alias("trained"),
        F.when(trained, end - F.length("text") - len(CLOSE)).otherwise(end).alias("loss_start"),
        F.when(trained, end - 1).otherwise(end).alias("loss_end"),
    )
