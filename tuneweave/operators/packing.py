"""Sequence packing and batch layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_count, tokens
from ..params import TrainLayout
from ..session import stored
from .ordering import BEFORE, BUCKET, TOTAL, bucket_offsets, running_start, with_order


# Offsets have at most 65,536 rows per epoch; up to here they are broadcast, beyond it
# Spark joins them by measured size.
BROADCAST_EPOCHS = 16


def _lengths(df: DataFrame, key: str, size: Column) -> DataFrame:
    """Written once: the key and `_n`, the tokens of each document and one end token. No later pass counts tokens."""
    return stored(df.select(key, (size + 1).cast("long").alias("_n")), "lengths")


def _placed(lengths: DataFrame, key: str, seed: int) -> DataFrame:
    """`key, _n, _start, _end, _total`: where each document lies in the sequence of all tokens.

    A document starts where the ones before it in seeded order end.
    """
    ordered = with_order(lengths, key, seed, "pack")
    offsets = bucket_offsets(ordered, F.col("_n")).select(BUCKET, BEFORE, TOTAL)
    return (
        ordered.withColumn("_in_bucket", running_start(ordered, key, F.col("_n")))
        .join(F.broadcast(offsets), BUCKET)
        .withColumn("_start", F.col(BEFORE) + F.col("_in_bucket"))
        .select(key, "_n", "_start", (F.col("_start") + F.col("_n")).alias("_end"), TOTAL)
    )


def _chunks(block: int) -> Column:
    """The blocks that a placed document touches."""
    return F.sequence(F.expr(f"_start div {block}"), F.expr(f"(_end - 1) div {block}"))


def _slice(chunk: Column, block: int) -> tuple[Column, Column]:
    """First token of a document in a block, and the one after its last."""
    return F.greatest("_start", chunk * block) - F.col("_start"), F.least("_end", (chunk + 1) * block) - F.col("_start")


def _size(text: str, length: str | None, ids: str | None = None) -> Column:
    if length:
        return F.col(length)
    return F.size(ids) if ids else token_count(F.col(text))


def pack_membership(
    df: DataFrame, block: int, key: str, seed: int, text: str = "text", length: str | None = None
) -> DataFrame:
    """`chunk_id, key, from_token, to_token`: which tokens of which document fill which block.

    Only complete blocks count. `length` names a column of token counts, as prepared rows
    have; with it no text is read, and without it the text is read once.
    """
    placed = _placed(_lengths(df, key, _size(text, length)), key, seed)
    first, end = _slice(F.col("chunk_id"), block)
    return (
        placed.withColumn("chunk_id", F.explode(_chunks(block)))
        .where(F.col("chunk_id") < F.expr(f"{TOTAL} div {block}"))
        .select("chunk_id", key, first.alias("from_token"), end.alias("to_token"))
    )


def pack_blocks(
    df: DataFrame,
    block: int,
    key: str,
    seed: int,
    text: str = "text",
    eos: str | int = "<eos>",
    length: str | None = None,
    ids: str | None = None,
) -> DataFrame:
    """The blocks themselves: `chunk_id, n_docs, n_tokens, tokens`.

    Documents are placed by their lengths alone. Then each is joined with its place, split into
    tokens once and cut into all its slices, so work is linear in its length and a
    group of the shuffle by block holds `block` tokens at most. `ids`
    names an array column of token ids to pack in place of words; `eos` is then an id.
    """
    placed = _placed(_lengths(df, key, _size(text, length, ids)), key, seed)
    sequence = F.concat(F.col(ids) if ids else tokens(F.col(text)), F.array(F.lit(eos)))

    def part(chunk: Column, all_tokens: Column) -> Column:
        first, end = _slice(chunk, block)
        cut = F.slice(all_tokens, (first + 1).cast("int"), (end - first).cast("int"))
        position = F.greatest(F.col("_start"), chunk * block) - chunk * block
        return F.struct(chunk.alias("chunk_id"), position.alias("position"), cut.alias("tokens"))

    # The outer array of one binds the tokens to a name, so that they are not split again for each slice.
    slices = F.flatten(F.transform(F.array(sequence), lambda t: F.transform(_chunks(block), lambda c: part(c, t))))
    return (
        df.select(key, ids or text)
        .join(placed, key)
        .select(TOTAL, F.inline(slices))
        .where(F.col("chunk_id") < F.expr(f"{TOTAL} div {block}"))
        .groupBy("chunk_id")
        .agg(F.array_sort(F.collect_list(F.struct("position", "tokens"))).alias("parts"))
        .select(
            "chunk_id",
            F.size("parts").cast("long").alias("n_docs"),
            F.flatten(F.col("parts.tokens")).alias("tokens"),
        )
        .select("chunk_id", "n_docs", F.size("tokens").cast("long").alias("n_tokens"), "tokens")
    )


def pack_stats(
    df: DataFrame, block: int, key: str, text: str = "text", seed: int = 0, length: str | None = None
) -> DataFrame:
    """Blocks, tokens placed, tokens left over, and documents per block."""
    placed = _placed(_lengths(df, key, _size(text, length)), key, seed)
    last = F.least(F.expr(f"(_end - 1) div {block}"), F.expr(f"{TOTAL} div {block}") - 1)
    touched = F.when(F.col("_n").isNotNull(), F.greatest(last - F.expr(f"_start div {block}") + 1, F.lit(0)))
    members = F.coalesce(F.col("_members"), F.lit(0))
    return (
        placed.agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_tokens"),
            F.sum(touched).alias("_members"),
        )
        .withColumn("n_blocks", F.expr(f"n_tokens div {block}"))
        .withColumn("dropped_tokens", F.col("n_tokens") % block)
        .withColumn("fill", F.col("n_blocks") * block / F.nullif(F.col("n_tokens"), F.lit(0)))
        .withColumn("docs_per_block", members / F.nullif(F.col("n_blocks"), F.lit(0)))
        .drop("_members")
    )


def step_plan(df: DataFrame, key: str, layout: TrainLayout, seed: int) -> DataFrame:
    """Which row is read in which optimizer step.

    Each epoch has its own order. Steps count from 1 over all epochs; the last
    one of an epoch may be partial. With `max_steps`, buckets that start after
    the last step are dropped before anything is sorted.
    """
    per_step = layout.rows_per_step
    rows = df.select(key, F.explode(F.sequence(F.lit(0), F.lit(layout.epochs - 1))).alias("epoch"))
    ordered = with_order(rows, key, seed, "step", F.col("epoch").cast("string"))
    offsets = (
        bucket_offsets(ordered, F.lit(1), ["epoch"])
        .withColumn("_steps", F.expr(f"(_total + {per_step - 1}) div {per_step}"))
        .withColumn("_first", F.col("epoch") * F.col("_steps"))
        .select("epoch", BUCKET, BEFORE, "_first")
    )
    step = F.col("_first") + F.expr(f"_rank div {per_step}") + 1
    if layout.max_steps:
        offsets = offsets.where(F.col("_first") + F.expr(f"_before div {per_step}") < layout.max_steps)
    if layout.epochs <= BROADCAST_EPOCHS:
        offsets = F.broadcast(offsets)
    placed = ordered.join(offsets, ["epoch", BUCKET])
    in_bucket = running_start(placed, key, F.lit(1), ["epoch"])
    plan = (
        placed.withColumn("_rank", F.col(BEFORE) + in_bucket)
        .withColumn("step", step)
        .withColumn("micro_batch", F.expr(f"(_rank % {per_step}) div {layout.batch_size}"))
        .withColumn("slot", F.col("_rank") % layout.batch_size)
    )
    if layout.max_steps:
        plan = plan.where(F.col("step") <= layout.max_steps)
    return plan.select(
        "epoch",
        "step",
        "micro_batch",
        "slot",
        key,
        (F.col("step") % layout.logging_steps == 0).alias("log_mark"),
        (F.col("step") % layout.eval_steps == 0).alias("eval_mark"),
        (F.col("step") % layout.eval_steps == 0).alias("save_mark"),
    )
