"""Conversations stored one turn per row, read as examples.

This turns a table of turns into the input/completion rows the other operators work on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Turns of one conversation that a single task may hold. Longer conversations are split.
BLOCK_TURNS = 16_384


def conversation_inputs(turns: DataFrame) -> DataFrame:
    """`conv_id, turn, input` of each user turn: what `conversation_pairs` says of them without the
    other turns. The scan alone, with the filter pushed into it, so nothing is shuffled."""
    return turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("input"))


def conversation_pairs(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per user turn: `conv_id, turn, instruction, input, completion`.

    The completion is the text of the next turn if that is the assistant's, the instruction
    the conversation's system text. `turn` numbers from 0 and is unique in a conversation.

    The window is on blocks of a conversation, so a conversation that holds a large part of the
    table is spread over many tasks. A block's last turn needs the first turn of the next block,
    and every block of a long conversation its system text. Both come from the shuffle that the
    blocks are made by, which is done once and read twice, so that the table is read once; only
    first turns past the first block and system texts are shuffled a second time.
    """
    block = F.floor(F.col("turn") / block_turns).alias("block")
    rows = turns.select("conv_id", "turn", "role", "text", block).repartition("conv_id", "block")
    in_order = Window.partitionBy("conv_id", "block").orderBy("turn")
    whole_block = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = rows.select(
        "*",
        F.max(F.when(F.col("role") == "system", F.col("text"))).over(whole_block).alias("system"),
        F.lead("role").over(in_order).alias("next_role"),
        F.lead("text").over(in_order).alias("next_text"),
        F.lead("turn").over(in_order).alias("next_turn"),
        F.min("turn").over(whole_block).alias("first_turn"),
    )
    beyond = _beyond_blocks(placed)
    joined = placed.join(beyond, ["conv_id", "block"], "left")
    next_role = F.when(F.col("next_turn").isNull(), F.col("head_role")).otherwise(F.col("next_role"))
    next_text = F.when(F.col("next_turn").isNull(), F.col("head_text")).otherwise(F.col("next_text"))
    return joined.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.coalesce("whole_system", "system").alias("instruction"), F.col("text").alias("input"),
        F.when(next_role == "assistant", next_text).alias("completion"),
    )


def _beyond_blocks(placed: DataFrame) -> DataFrame:
    """For the blocks of conversations with several: the next block's first turn, and the system text of all."""
    heads = placed.filter((F.col("turn") == F.col("first_turn")) & ((F.col("block") > 0) | F.col("system").isNotNull()))
    in_order = Window.partitionBy("conv_id").orderBy("block")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = heads.select("conv_id", "block", "role", "text", F.max("system").over(whole).alias("system"),
                         F.lag("block").over(in_order).alias("before"), F.lead("block").over(in_order).alias("after"))

    def entry(block: Column, role: Column, text: Column) -> Column:
        keys = (F.col("conv_id"), block.alias("block"), F.col("system").alias("whole_system"))
        return F.struct(*keys, role.alias("head_role"), text.alias("head_text"))

    none = F.lit(None).cast("string")
    ahead = entry(F.coalesce("before", F.lit(0).cast("bigint")), F.col("role"), F.col("text"))
    last = F.when(F.col("after").isNull(), entry(F.col("block"), none, none))
    return known.filter("block > 0").select(F.inline(F.array_compact(F.array(ahead, last))))
