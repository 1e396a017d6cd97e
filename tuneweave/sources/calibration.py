"""Calibration sets in JSON, CSV or text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank, strip


def load_calibration(
    spark: SparkSession, path: str, suffix: str, multi_line_csv: bool = True, schema: str | None = None
) -> DataFrame:
    """Rows of a calibration set by file suffix; anything but JSON and CSV is text, one row per non-blank line.

    CSV fields may hold line breaks, which needs whole files per task; set
    `multi_line_csv` to False where they do not, so that large files are split. With a
    `schema` JSON files are read once instead of twice. Malformed JSON fails the job.
    """
    kind = suffix.lower()
    if kind in (".json", ".jsonl"):
        reader = spark.read.option("mode", "FAILFAST")
        return (reader.schema(schema) if schema else reader).json(path)
    if kind == ".csv":
        return spark.read.csv(path, header=True, multiLine=multi_line_csv, escape='"')
    lines = spark.read.text(path).where(~is_blank(F.col("value"))).select(strip(F.col("value")).alias("text"))
    if lines.isEmpty():
        raise ValueError(f"calibration set {path} is empty after dropping blank lines")
    return lines
