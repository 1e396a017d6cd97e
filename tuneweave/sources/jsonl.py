"""JSON-lines splits: strict and lenient reading, line numbers, rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank, strip

REQUIRED_SPLITS = ["train", "validation"]


def raw_lines(spark: SparkSession, path: str, file: str | None = None) -> DataFrame:
    """Lines of text files, or of one `file` of them, as `file, value`, with the file block and row id that place them."""
    lines = spark.read.text(path)
    if file is not None:
        lines = lines.where(F.col("_metadata.file_path") == file)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )


def with_line_numbers(lines: DataFrame, raw: DataFrame) -> DataFrame:
    """Add `line_no`, from 1 in every file, to some of the raw lines.

    Row ids grow by one along a file block, so a line's number is the lines in
    the blocks before it, plus its distance from the first id of its own. Of
    the raw lines only one row per block is shuffled. Should the two scans ever
    be cut into different blocks, the job fails instead of numbering wrongly.
    """
    blocks = raw.groupBy("file", "_at").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.expr("sum(_n) over (partition by file order by _at) - _n")
    starts = blocks.select("file", "_at", "_first", "_n", before.alias("_before"))
    offset = F.col("_id") - F.col("_first")
    in_block = F.coalesce((offset >= 0) & (offset < F.col("_n")), F.lit(False))
    line_no = F.when(in_block, F.col("_before") + offset + 1).otherwise(
        F.raise_error(F.lit("file blocks changed between scans")).cast("long")
    )
    kept = [c for c in lines.columns if c not in ("file", "_at", "_id")]
    return lines.join(starts, ["file", "_at"], "left").select("file", line_no.alias("line_no"), *kept)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of text files as `file, line_no, value`."""
    raw = raw_lines(spark, path)
    return with_line_numbers(raw, raw)


def _parsed(value: Column) -> Column:
    return F.try_parse_json(value)


def check_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add `text` and `reason` (null for good records); blank lines are left out.

    A record is an object with a string `text`, which may be empty.
    """
    parsed = lines.where(~is_blank(F.col(value))).withColumn("_json", _parsed(strip(F.col(value))))
    kind = F.schema_of_variant(F.try_variant_get("_json", "$.text", "variant"))
    reason = (
        F.when(F.col("_json").isNull(), "invalid_json")
        .when(F.coalesce(kind, F.lit("")) != "STRING", "missing_text")
    )
    return parsed.select(
        *lines.columns,
        F.when(reason.isNull(), F.try_variant_get("_json", "$.text", "string")).alias("text"),
        reason.alias("reason"),
    )


def good_records(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).drop("reason")


def rejected_records(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).drop("text")


def load_rejects(spark: SparkSession, path: str, file: str | None = None) -> DataFrame:
    """`file, line_no, value, reason` of bad records; good ones are not shuffled for it."""
    raw = raw_lines(spark, path, file)
    return with_line_numbers(rejected_records(check_records(raw)), raw)


def split_of(file: Column) -> Column:
    """The split a file belongs to: its `split=` folder, else its own name up to the first dot."""
    folder = F.regexp_extract(file, "/split=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(file, r"([^/.]+)[^/]*$", 1))


def load_strict(spark: SparkSession, path: str, splits: Sequence[str] = ()) -> DataFrame:
    """`file, text` of all files below `path`; a bad record is an error that names file and line, as is the lack of one of `splits`.

    The check is one pass that yields a row for each split. The rows then come straight from the
    scan. Lines are numbered only in the first file that holds a bad record.
    """
    checked = check_records(raw_lines(spark, path))
    bad = F.min(F.when(F.col("reason").isNotNull(), F.col("file")))
    found = checked.groupBy(split_of(F.col("file")).alias("split")).agg(bad.alias("bad"))
    first = found.agg(F.min("bad").alias("bad"), F.collect_set(F.when(F.col("split").isin(*splits), F.col("split"))).alias("there")).first()
    absent = [name for name in splits if name not in first.there]
    if absent:
        raise ValueError(f"no records of split {', '.join(absent)} in {path}")
    if first.bad is not None:
        line = load_rejects(spark, path, first.bad).orderBy("line_no").first()
        raise ValueError(f"{line.reason} in {line.file} at line {line.line_no}")
    return good_records(checked).select("file", "text")


def load_validation(spark: SparkSession, path: str) -> DataFrame:
    """Lenient reader: records with a non-empty string `text`; white space alone counts as text. A line that is no JSON fails the job."""
    checked = check_records(raw_lines(spark, path))
    broken = F.raise_error(F.concat(F.lit("invalid_json in "), F.col("file"))).cast("string")
    text = F.when(F.col("reason") == "invalid_json", broken).otherwise(F.col("text"))
    return checked.select(text.alias("text")).where(F.col("text").isNotNull() & (F.col("text") != ""))


def missing_splits(manifest: DataFrame, split: str = "split") -> DataFrame:
    """Required splits that the manifest does not list."""
    spark = manifest.sparkSession
    required = spark.createDataFrame([(name,) for name in REQUIRED_SPLITS], f"{split} string")
    return required.join(manifest.select(split).distinct(), split, "left_anti")
