"""Directory listings and run metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import base_name, parent_path


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """`dir, file, mtime, length` of all files below a path; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    # A URI may spell the same local path as file:/x or file:///x.
    plain = F.regexp_replace("path", r"\Afile:/+", "/")
    return reader.load(path).select(
        parent_path(plain).alias("dir"),
        base_name(plain).alias("file"),
        F.col("modificationTime").alias("mtime"),
        "length",
    )


def read_run_metadata(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON summaries of many runs, with the file each came from."""
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
