"""Writers. Spark's commit protocol makes each of them atomic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, split: str = "split", text: str = "text") -> None:
    """JSON lines `{"text": ...}` below `split=train` and `split=validation`."""
    df.select(text, split).write.partitionBy(split).mode("overwrite").option("ignoreNullFields", False).json(path)


def write_summary(df: DataFrame, path: str, section: str, by: list[str] | None = None) -> None:
    """Rows as JSON objects `{section: {...}}` with sorted fields, one folder per value of `by`."""
    by = by or []
    fields = sorted(c for c in df.columns if c not in by)
    out = df.select(F.struct(*fields).alias(section), *by)
    (out.write.partitionBy(*by) if by else out.write).mode("overwrite").option("ignoreNullFields", False).json(path)


def write_scalars(df: DataFrame, path: str, run: str = "source") -> None:
    """Scalar series sorted by run, tag and step, so that a reader of one run skips the rest by file statistics.

    One folder per run would mean as many files as runs. A very long series is
    cut by step range: no run has to fit one task. Records without a step go by
    their position `line_no`, if there is one.
    """
    place = F.coalesce("step", "line_no") if "line_no" in df.columns else F.col("step")
    pieces = df.repartition(run, (place / 1000000).cast("long"))
    pieces.sortWithinPartitions(run, "tag", place).write.mode("overwrite").parquet(path)
