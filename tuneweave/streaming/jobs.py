"""Structured Streaming jobs.

Every job runs with the `availableNow` trigger: it works through what has
arrived, keeps its position in the checkpoint and stops. Run it again, or pass
another trigger, for more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.growing import GrowingSample
from ..operators.logs import LINES_PER_ROW, route
from ..operators.metrics import latest_values, metric_events, metric_scalars
from .records import stitch_stream

Transform = Callable[[DataFrame], DataFrame]


def follow_parquet(spark: SparkSession, folder: str, pattern: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def follow_text(spark: SparkSession, folder: str) -> DataFrame:
    """New lines of growing log folders, with the file as `source`."""
    return spark.readStream.text(folder).select(F.col("_metadata.file_path").alias("source"), "value")


def append(stream: DataFrame, out: str, checkpoint: str, transform: Transform, fmt: str = "parquet") -> StreamingQuery:
    """Write a row-local transform of a stream."""
    return (
        transform(stream)
        .writeStream.format(fmt)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def scalars(lines: DataFrame) -> DataFrame:
    """Log lines to scalar series; the same on a batch and on a stream."""
    return metric_scalars(metric_events(lines))


def write_routed(lines: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """One stream to two tables, `console` and `file`.

    Each batch replaces its own `batch_id` folder, so a replayed batch leaves no copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = route(batch).persist()
        try:
            for target in ("console", "file"):
                (
                    routed.where(F.col(f"to_{target}"))
                    .drop("to_console", "to_file")
                    .write.mode("overwrite")
                    .parquet(f"{out}/{target}/batch_id={batch_id}")
                )
        finally:
            routed.unpersist()

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_stitched(lines: DataFrame, out: str, checkpoint: str, per_row: int = LINES_PER_ROW) -> StreamingQuery:
    """Records stitched from the lines of a stream, without time-outs; see `streaming.records`."""
    return append(stitch_stream(lines, per_row), out, checkpoint, lambda records: records)


def grow_sample(stream: DataFrame, sample: GrowingSample, checkpoint: str) -> StreamingQuery:
    """Each batch of a growing corpus becomes a version of its exact sample."""
    return (
        stream.writeStream.foreachBatch(sample.add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_latest(
    stream: DataFrame, out: str, checkpoint: str, run: str = "source", position: str = "line_no"
) -> StreamingQuery:
    """Last value per run, kind and tag, kept in the state store; each batch writes the groups it changed."""
    latest = stream.groupBy(run, "kind", "tag").agg(*latest_values(position))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        latest.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, out: str, run: str = "source", position: str = "line_no") -> DataFrame:
    """The state after the last batch that touched each group."""
    last = F.max_by(F.struct(position, "step", "value", "n_values"), "batch_id").alias("s")
    return spark.read.parquet(out).groupBy(run, "kind", "tag").agg(last).select(run, "kind", "tag", "s.*")
