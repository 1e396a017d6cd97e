"""Seeded global order without a global window.

Rows are ordered by `(md5(seed:tag:key), key)`. The first four hex digits of
the hash are a bucket: 65,536 of them whatever the data, even in size since
keys are unique. A global running sum is then

1. one small aggregate per bucket and a running sum over those totals
   (at most 65,536 rows per group), and
2. a window inside each bucket, to which the bucket's offset is added.

Everything is a pure function of the row key, so a lost executor or a different
partitioning gives the same result. `key` must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hashing import order_hash
from ..session import stored

BUCKET_DIGITS = 4
HASH, BUCKET = "_hash", "_bucket"
BEFORE, WITHIN, TOTAL = "_before", "_within", "_total"


def with_order(df: DataFrame, key: str, seed: int, tag: str, *more: Column) -> DataFrame:
    """Add the order hash and its bucket."""
    hashed = df.withColumn(HASH, order_hash(F.col(key), seed, tag, *more))
    return hashed.withColumn(BUCKET, F.substring(HASH, 1, BUCKET_DIGITS))


def bucket_offsets(ordered: DataFrame, weight: Column, group: list[str] | None = None) -> DataFrame:
    """Per bucket: weight before it, within it, and in total. At most 65,536 rows per group."""
    group = group or []
    totals = ordered.groupBy(*group, BUCKET).agg(F.sum(weight).alias(WITHIN))
    by_group = W.partitionBy(*group)
    running = F.sum(WITHIN).over(by_group.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, 0))
    return totals.select(
        *group,
        BUCKET,
        WITHIN,
        (running - F.col(WITHIN)).alias(BEFORE),
        F.sum(WITHIN).over(by_group).alias(TOTAL),
    )


def running_start(ordered: DataFrame, key: str, weight: Column, group: list[str] | None = None) -> Column:
    """Weight of the rows before this one in its own bucket."""
    in_order = W.partitionBy(*(group or []), BUCKET).orderBy(HASH, key)
    before = F.sum(weight).over(in_order.rowsBetween(W.unboundedPreceding, -1))
    return F.coalesce(before, F.lit(0))


def cut_points(ordered: DataFrame, key: str, wanted: Column) -> DataFrame:
    """The buckets that hold the first `wanted` rows, and where the last one is cut.

    `wanted` may use the total row count. The bucket counts are stored, so the
    keys are scanned once for them and once for the one bucket that the cut
    falls in, whose rows alone are ranked. The result has at most 65,536 rows.
    """
    offsets = stored(bucket_offsets(ordered, F.lit(1)).withColumn("_wanted", wanted), "offsets")
    inside = offsets.where(F.col(BEFORE) < F.col("_wanted"))
    edge = inside.where(F.col(BEFORE) + F.col(WITHIN) > F.col("_wanted"))
    rank = F.row_number().over(W.partitionBy(BUCKET).orderBy(HASH, key))
    last = (
        ordered.select(BUCKET, HASH, key)
        .join(F.broadcast(edge.select(BUCKET, BEFORE, "_wanted")), BUCKET)
        .withColumn("_rank", rank)
        .where(F.col("_rank") + F.col(BEFORE) == F.col("_wanted"))
        .select(BUCKET, F.struct(F.col(HASH), F.col(key)).alias("_last"))
    )
    if edge.isEmpty():
        last = last.limit(0)
    return inside.select(BUCKET, TOTAL, "_wanted").join(last, BUCKET, "left")


def before_cut(key: str) -> Column:
    """True for rows up to and with the cut of their bucket."""
    here = F.struct(F.col(HASH), F.col(key))
    return F.col("_last").isNull() | (here <= F.col("_last"))
