"""Log records: parsing, stitching, routing, tails.

Input rows are `source, line_no, value`: the file or run, the position of the
line in it (growing, gaps allowed) and the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_log_text, strip

# The record format, the level ranks and the metric markers.
RECORD = r"(?s)\A(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d) \| (\w+) *\| ([^|]*?) \| (.*)\z"
HEADER = r"\A\d{4}-\d\d-\d\d \d\d:\d\d:\d\d \| \w+ *\| "
LEVELS = {
    "NOTSET": 0,
    "DEBUG": 10,
    "INFO": 20,
    "WARN": 30,
    "WARNING": 30,
    "ERROR": 40,
    "CRITICAL": 50,
    "FATAL": 50,
}
METRIC_MARKERS = ["TRAIN_METRICS", "EVAL_METRICS"]
ENV_LINE = r"\A[A-Z][A-Z0-9_]*=.*"

LINES_PER_BLOCK = 65_536
LINES_PER_ROW = 1024


def level_rank(level: Column) -> Column:
    rank = F.lit(None).cast("int")
    for name, value in LEVELS.items():
        rank = F.when(F.upper(level) == name, value).otherwise(rank)
    return rank


def record_fields(text: Column) -> list[Column]:
    """`ts, level, logger, message` of a record text."""
    part = [F.regexp_extract(text, RECORD, i) for i in (1, 2, 3, 4)]
    return [
        F.try_to_timestamp(part[0], F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        part[1].alias("level"),
        part[2].alias("logger"),
        part[3].alias("message"),
    ]


def _block(order: str, size: int) -> Column:
    return F.expr(f"{order} div {size}")


def stitch_records(lines: DataFrame, per_block: int = LINES_PER_BLOCK, per_row: int = LINES_PER_ROW) -> DataFrame:
    """Lines with the header line of their record: `source, line_no, record, segment, value`.

    Lines before the first header belong to no record and keep a null `record`; their segments count from the first line.
    The header is looked up inside blocks of lines; what a block inherits from
    the ones before it comes from one row per block. So a log of any length is
    spread over many tasks.
    """
    header = F.when(F.col("value").rlike(HEADER), F.col("line_no"))
    blocked = lines.withColumn("_block", _block("line_no", per_block)).withColumn("_header", header)
    per_file = W.partitionBy("source").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    inherited = (
        blocked.groupBy("source", "_block")
        .agg(F.max("_header").alias("_max"), F.min("line_no").alias("_min"))
        .select(
            "source",
            "_block",
            F.max("_max").over(per_file).alias("_inherited"),
            F.min("_min").over(W.partitionBy("source")).alias("_first"),
        )
    )
    in_block = W.partitionBy("source", "_block").orderBy("line_no")
    own = F.max("_header").over(in_block.rowsBetween(W.unboundedPreceding, 0))
    return (
        blocked.withColumn("_own", own)
        .join(inherited, ["source", "_block"])
        .select("source", "line_no", F.coalesce("_own", "_inherited").alias("record"), "value", "_first")
        .withColumn("segment", F.expr(f"(line_no - coalesce(record, _first)) div {per_row}"))
        .drop("_first")
    )


def rotated_lines(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Lines of rotated files as lines of their run: `source` is the run and `line_no` goes on from file to file.

    `files` has a row for each file: `source, run, position`, positions growing from the oldest file.
    So a file that begins in the middle of a record goes on with the record of the file before it.
    """
    before = W.partitionBy("run").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    length = lines.groupBy("source").agg((F.max("line_no") + 1).alias("_length"))
    start = files.join(length, "source").select("source", "run", F.coalesce(F.sum("_length").over(before), F.lit(0)).alias("_start"))
    return lines.join(start, "source").select(F.col("run").alias("source"), (F.col("_start") + F.col("line_no")).alias("line_no"), "value")


def read_records(
    lines: DataFrame, per_block: int = LINES_PER_BLOCK, per_row: int = LINES_PER_ROW, headless: bool = False
) -> DataFrame:
    """`source, record, segment, ts, level, logger, message`.

    With `headless`, the lines before a source's first header are rows too, with a null `record` and null header fields;
    without it they are left out.

    A record longer than `per_row` lines goes on in rows with higher
    `segment`, whose message is the text that follows; they carry the header's fields too.
    """
    stitched = stitch_records(lines, per_block, per_row)
    if not headless:
        stitched = stitched.where(F.col("record").isNotNull())
    line = F.struct("line_no", "value")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["value"]), "\n")
    grouped = stitched.groupBy("source", "record", "segment").agg(text.alias("_text"))
    ts, level, logger, message = record_fields(F.col("_text"))
    more = F.col("segment") > 0
    # One row for each `per_row` lines of a record, so these windows stay small.
    record = W.partitionBy("source", "record").orderBy("segment").rowsBetween(W.unboundedPreceding, 0)

    def header(field: Column, name: str) -> Column:
        return F.first(F.when(~more & F.col("record").isNotNull(), field), ignorenulls=True).over(record).alias(name)

    return grouped.select(
        "source",
        "record",
        "segment",
        header(ts, "ts"),
        header(level, "level"),
        header(logger, "logger"),
        F.when(more | F.col("record").isNull(), F.col("_text")).otherwise(message).alias("message"),
    )


def at_least(records: DataFrame, level: str) -> DataFrame:
    """Records of this severity or higher, and lines without a record, whose severity is not known."""
    if level.upper() not in LEVELS:
        raise ValueError(f"unknown level {level!r}")
    headless = F.col("record").isNull() if "record" in records.columns else F.lit(False)
    return records.where((level_rank(F.col("level")) >= LEVELS[level.upper()]) | headless)


def suppressed(text: Column) -> Column:
    """Texts kept off the console: metric records, and bare dict texts longer than two characters."""
    seen = strip(clean_log_text(text))
    marked = F.lit(False)
    for marker in METRIC_MARKERS:
        marked = marked | seen.contains(marker)
    return marked | (seen.startswith("{") & (F.length(seen) > 2))


def route(lines: DataFrame, text: str = "value") -> DataFrame:
    """Add where a text goes: the file gets all, the console what is not suppressed."""
    filled = F.col(text) != ""
    return lines.withColumn("to_file", filled).withColumn("to_console", filled & ~suppressed(F.col(text)))


def env_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Only `KEY=VALUE` lines, stripped."""
    return lines.withColumn(value, strip(F.col(value))).where(F.col(value).rlike(ENV_LINE))


def parse_env(lines: DataFrame) -> DataFrame:
    """`source, key, value`; the last line of a key wins."""
    split = F.regexp_extract
    return (
        env_lines(lines)
        .select(
            "source",
            "line_no",
            split("value", r"\A([^=]*)=", 1).alias("key"),
            split("value", r"(?s)\A[^=]*=(.*)\z", 1).alias("value"),
        )
        .groupBy("source", "key")
        .agg(F.max_by("value", "line_no").alias("value"))
    )


def tail(
    lines: DataFrame,
    keys: list[str],
    weight: Column,
    budget: int,
    order: str = "line_no",
    per_block: int = LINES_PER_BLOCK,
) -> DataFrame:
    """The last rows per key whose weights sum to `budget` at most; `_after` is the weight from a row to the end.

    Weights per block of rows are summed first. Blocks that lie before the
    budget are cut off by a semi-join on `(keys, block)`, so only the last
    few blocks of each key are ever sorted.
    """
    blocked = lines.withColumn("_block", _block(order, per_block)).withColumn("_weight", weight)
    blocked = blocked.where(F.col("_weight") > 0)
    from_end = W.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(W.unboundedPreceding, -1)
    reach = (
        blocked.groupBy(*keys, "_block")
        .agg(F.sum("_weight").alias("_within"))
        .withColumn("_later", F.coalesce(F.sum("_within").over(from_end), F.lit(0)))
        .where(F.col("_later") < budget)
        .select(*keys, "_block", "_later")
    )
    in_block = W.partitionBy(*keys, "_block").orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, 0)
    return (
        blocked.join(reach, [*keys, "_block"])
        .withColumn("_after", F.sum("_weight").over(in_block) + F.col("_later"))
        .where(F.col("_after") <= budget)
        .drop("_block", "_weight", "_later")
    )


def tail_lines(lines: DataFrame, keys: list[str], n: int = 2000, order: str = "line_no") -> DataFrame:
    """The last `n` lines per key."""
    return tail(lines, keys, F.lit(1), n, order).drop("_after")


def tail_chars(lines: DataFrame, keys: list[str], max_chars: int = 10_000, order: str = "line_no") -> DataFrame:
    """`keys, tail`: the last chunks per key, whole ones only, `max_chars` characters at most.

    A last chunk longer than the budget leaves an empty tail.
    """
    kept = tail(lines, keys, F.length("value").cast("long"), max_chars, order)
    chunk = F.struct(order, "value")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(chunk)), lambda x: x["value"]), "")
    tails = kept.groupBy(*keys).agg(text.alias("tail"))
    return lines.select(*keys).distinct().join(tails, keys, "left").fillna({"tail": ""})


def cut_tail(text: Column, max_chars: int = 10_000) -> Column:
    """The last `max_chars` characters of one text."""
    return F.when(F.length(text) > max_chars, F.right(text, F.lit(max_chars))).otherwise(F.coalesce(text, F.lit("")))
