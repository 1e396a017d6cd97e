"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneweave.session import stored


def _star(links: DataFrame, small: bool) -> DataFrame:
    """One step: each vertex hands its smallest neighbour to the larger (or, small star, to the other smaller) ones."""
    if not small:
        links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        found = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return links.where("b > a").join(found, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    found = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(found, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(found.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) for all vertices of `links`, whose two columns are ends of links; the component is its smallest vertex.

    Every step is written to the shared folder. The number of steps grows with the
    logarithm of the longest path; labels are compared by their checksum.
    """
    first, second = links.columns
    low, high = F.least(F.col(first), F.col(second)), F.greatest(F.col(first), F.col(second))
    state = stored(links.where(F.col(first) != F.col(second)).select(high.alias("a"), low.alias("b")).distinct(), "links")
    before = None
    while True:
        state = stored(_star(state, small=False), "links")
        state = stored(_star(state, small=True), "links")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    tops = state.select(F.col("b").alias("vertex")).distinct()
    return state.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
        tops.select("vertex", F.col("vertex").alias("component"))
    )
