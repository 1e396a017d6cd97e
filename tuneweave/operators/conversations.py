"""Chat turns to conversations and rendered training texts.

Input rows are `conv_id, turn, role, text`; `turn` is the position from 0 and
unique in its conversation. One row comes out for each conversation, whole
whatever its length: a row is what the caller asks for, so a conversation
must fit into a task's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.chat import render_piece
from ..functions.text import cutoff, token_count


def assemble_conversations(turns: DataFrame) -> DataFrame:
    """`conv_id, messages`, messages in turn order."""
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("messages"))


def _joined(pieces: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(pieces)), lambda p: p["piece"]), "")


def render_conversations(
    turns: DataFrame,
    template: str | Column,
    eos: str = "",
    bos: str = "",
) -> DataFrame:
    """`conv_id, text`; each turn is rendered before the shuffle."""
    piece = render_piece(template, F.col("role"), F.col("text"), F.col("turn"), eos, bos)
    pieces = turns.select("conv_id", "turn", F.struct("turn", piece.alias("piece")).alias("p"))
    return pieces.groupBy("conv_id").agg(_joined("p").alias("text"))


def conversation_texts(
    turns: DataFrame, template: str, cutoff_len: int, eos: str = "", bos: str = ""
) -> DataFrame:
    """One training text per conversation, cut to `cutoff_len` tokens.

    Each rendered turn adds at least one token, so the first `cutoff_len`
    turns that render to something decide the text. Turns below that position
    need no ranking. Only turns beyond it are ranked, first within stripes
    of the conversation and then over what the stripes leave. One token more
    than the limit is kept of each turn, enough to see that the text was cut.
    """
    piece = render_piece(template, F.col("role"), F.col("text"), F.col("turn"), eos, bos)
    pieces = (
        turns.select("conv_id", "turn", piece.alias("piece"))
        .where(F.col("piece") != "")
        .withColumn("piece", cutoff(F.col("piece"), cutoff_len + 1))
    )
    near = pieces.where(F.col("turn") < cutoff_len)
    far = pieces.where(F.col("turn") >= cutoff_len)
    stripe = F.expr(f"(turn div {cutoff_len}) % 1024")
    for keys in (["conv_id", "_stripe"], ["conv_id"]):
        in_turn_order = W.partitionBy(*keys).orderBy("turn")
        far = (
            far.withColumn("_stripe", stripe)
            .withColumn("_rank", F.row_number().over(in_turn_order))
            .where(F.col("_rank") <= cutoff_len)
            .select("conv_id", "turn", "piece")
        )
    n = F.col("n_tokens")
    return (
        near.unionByName(far)
        .select("conv_id", F.struct("turn", "piece").alias("p"))
        .groupBy("conv_id")
        .agg(_joined("p").alias("text"))
        .withColumn("n_tokens", token_count(F.col("text")))
        .select(
            "conv_id",
            cutoff(F.col("text"), cutoff_len, n).alias("text"),
            F.least(n, F.lit(cutoff_len)).alias("n_tokens"),
            (n > cutoff_len).alias("was_cut"),
        )
    )


def turn_pairs(turns: DataFrame) -> DataFrame:
    """User turns with the assistant turn right after them: `conv_id, turn, instruction, output`."""
    users = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction")
    )
    replies = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    return users.join(replies, ["conv_id", "turn"])
