"""Seeded sampling and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import split_label
from ..functions.text import cutoff, token_count
from ..session import stored
from .ordering import BUCKET, TOTAL, before_cut, cut_points, with_order


def sample_n(df: DataFrame, n: int | None, key: str, seed: int) -> DataFrame:
    """Exactly `min(n, rows)` rows in seeded order; `None` keeps all.

    The keys are stored once, whatever filters lead to them, and alone give the cut points; the
    rows themselves are then filtered where they are, so no text is shuffled or sorted.
    """
    if n is None:
        return df
    if n <= 0:
        raise ValueError("n must be positive")
    ordered = with_order(df, key, seed, "sample")
    keys = stored(df.select(key), "keys")
    cuts = cut_points(with_order(keys, key, seed, "sample"), key, F.lit(n))
    kept = ordered.join(F.broadcast(cuts.select(BUCKET, "_last")), BUCKET).where(before_cut(key))
    return kept.select(*df.columns)


def split_hash(df: DataFrame, test_size: float, key: str, seed: int) -> DataFrame:
    """Row-local split: a row's label never changes as the corpus grows."""
    return df.withColumn("split", split_label(F.col(key), test_size, seed))


def split_exact(df: DataFrame, test_size: float, key: str, seed: int) -> DataFrame:
    """Split with exactly `ceil(rows * test_size)` validation rows."""
    ordered = with_order(df, key, seed, "split")
    wanted = F.ceil(F.col(TOTAL) * F.lit(test_size))
    cuts = cut_points(ordered, key, wanted).select(BUCKET, "_last", F.lit(True).alias("_inside"))
    held_out = F.coalesce(F.col("_inside"), F.lit(False)) & before_cut(key)
    return (
        ordered.join(F.broadcast(cuts), BUCKET, "left")
        .withColumn("split", F.when(held_out, "validation").otherwise("train"))
        .select(*df.columns, "split")
    )


def calibration_sample(
    df: DataFrame, samples: int, max_tokens: int, key: str, seed: int, text: str = "text"
) -> DataFrame:
    """Up to `samples` rows, each cut to `max_tokens` tokens."""
    counted = sample_n(df, samples, key, seed).withColumn("n_tokens", token_count(F.col(text)))
    return counted.withColumn(text, cutoff(F.col(text), max_tokens, F.col("n_tokens"))).withColumn(
        "n_tokens", F.least(F.col("n_tokens"), F.lit(max_tokens))
    )


def calibration_report(df: DataFrame, samples: int) -> DataFrame:
    """Rows asked for, rows there, rows used."""
    return df.agg(F.count(F.lit(1)).alias("available")).select(
        F.lit(samples).cast("long").alias("requested"),
        "available",
        F.least(F.lit(samples).cast("long"), F.col("available")).alias("used"),
    )


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))
