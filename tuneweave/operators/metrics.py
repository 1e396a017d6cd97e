"""Metric records to scalar series.

`metric_events` and `metric_scalars` are row-local, so the same functions run
on a batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

# The markers, longest first, and the number format of scalars.
MARKED = r"(?s)(FINAL_TRAIN_METRICS|FINAL_EVAL_METRICS|TRAIN_METRICS): (\{.*\})"
NUMBER = r"(?i)\A[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|inf(?:inity)?)\z"


def _payload(text: Column) -> Column:
    """JSON, or a Python dict text with its own spelling of the constants."""
    as_json = text
    for word, value in {"None": "null", "True": "true", "False": "false"}.items():
        as_json = F.regexp_replace(as_json, rf"(?<=[:\s,\[]){word}(?=[\s,}}\]])", value)
    return F.when(text.startswith("{'"), as_json).otherwise(text)


def metric_events(lines: DataFrame, value: str = "value", step_key: str = "step") -> DataFrame:
    """`<other columns>, kind, step, tag, raw`: one row per tag of every metric record.

    The step is the payload's own `step_key` entry, null where it has none. What
    is last in a run is decided by the position of the line, not by the step.
    """
    others = [c for c in lines.columns if c != value]
    parsed = lines.where(F.col(value).contains("_METRICS: {")).select(
        *others,
        F.regexp_extract(value, MARKED, 1).alias("kind"),
        F.from_json(_payload(F.regexp_extract(value, MARKED, 2)), "map<string,string>").alias("_map"),
    )
    exploded = parsed.where(F.col("kind") != "").select(
        *others,
        "kind",
        F.try_element_at("_map", F.lit(step_key)).try_cast("long").alias("step"),
        F.explode("_map").alias("tag", "raw"),
    )
    return exploded.where(F.col("tag") != step_key)


def to_scalar(raw: Column) -> Column:
    """Numbers and booleans as double, all else null. NaN counts as a number."""
    bare = F.lower(strip(F.regexp_replace(raw, r'\A"|"\z', "")))
    spelled = F.regexp_replace(F.regexp_replace(bare, r"\A\+", ""), r"inf\z", "infinity")
    return (
        F.when(bare.isin("true", "false"), (bare == "true").cast("double"))
        .when(bare.rlike(NUMBER), spelled.try_cast("double"))
    )


def metric_scalars(events: DataFrame) -> DataFrame:
    """Numeric tags only: `<other columns>, kind, step, tag, value`."""
    scalars = events.withColumn("value", to_scalar(F.col("raw"))).drop("raw")
    return scalars.where(F.col("value").isNotNull())


def latest_values(position: str) -> list[Column]:
    """Position, step and value of the last record of a group, and the number of values; one record has a tag once."""
    return [
        F.max(position).alias(position),
        F.max_by("step", position).alias("step"),
        F.max_by("value", position).alias("value"),
        F.count(F.lit(1)).alias("n_values"),
    ]


def metric_latest(scalars: DataFrame, run: str = "source", position: str = "line_no") -> DataFrame:
    """The last value in the log per run, kind of record and tag."""
    return scalars.groupBy(run, "kind", "tag").agg(*latest_values(position))


def training_summary(
    scalars: DataFrame, default_epochs: float, run: str = "source", position: str = "line_no"
) -> DataFrame:
    """The last reported figures per run; a run without a train loss gets NaN."""

    def last(kind: str, tag: str) -> Column:
        here = (F.col("kind") == kind) & (F.col("tag") == tag)
        return F.max_by(F.when(here, F.col("value")), F.when(here, F.col(position)))

    train, final_eval = "FINAL_TRAIN_METRICS", "FINAL_EVAL_METRICS"
    return scalars.groupBy(run).agg(
        F.coalesce(last(train, "train_loss"), F.lit(float("nan"))).alias("train_loss"),
        last(final_eval, "eval_loss").alias("eval_loss"),
        F.coalesce(last(train, "epoch"), F.lit(float(default_epochs))).alias("epochs"),
        last(train, "train_tokens").cast("long").alias("total_tokens"),
    )
