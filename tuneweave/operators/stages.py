"""Stage guards, stage chains, retries and reuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stages that need a finished run, and the meaning of return codes.
POST_TRAINING = ["export-merged", "convert-awq", "eval-sft", "serve-vllm"]
RETURN_CODES = {
    0: "success",
    2: "compression exception",
    3: "missing merged path",
    4: "GPU requested but not available",
    5: "output exists and not forced",
}
BACKOFF_SECONDS = 5


def stage_guard(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """Requests `request_id, run, stage` with `status`: post-training stages need an existing run."""
    needs_run = F.lower(F.trim(F.col("stage"))).isin(POST_TRAINING)
    there = runs.select("run").distinct().withColumn("_there", F.lit(True))
    blocked = needs_run & F.col("_there").isNull()
    return requests.join(there, "run", "left").select(
        "request_id", "run", "stage", F.when(blocked, "blocked").otherwise("allowed").alias("status")
    )


def stage_chain(stages: DataFrame) -> DataFrame:
    """`run, position, stage, returncode` with `status`: the chain stops at its first failure.

    Unknown stages count as done, with a warning.
    """
    known = F.lower("stage").isin(POST_TRAINING)
    failed = known & (F.col("returncode") != 0)
    stops = stages.where(failed).groupBy("run").agg(F.min("position").alias("_stop"))
    status = (
        F.when(F.col("position") > F.col("_stop"), "not_run")
        .when(F.col("position") == F.col("_stop"), "failed")
        .when(~known, "unknown_stage")
        .otherwise("ok")
    )
    return stages.join(stops, "run", "left").select("run", "position", "stage", "returncode", status.alias("status"))


def code_meaning(code: Column) -> Column:
    meaning = F.lit("other")
    for value, text in RETURN_CODES.items():
        meaning = F.when(code == value, text).otherwise(meaning)
    return meaning


def attempt_rollup(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """Per run: attempts made, final return code and its meaning, seconds waited between attempts.

    `attempts`: `run, attempt, returncode`, attempts from 1 and none after a success.
    """
    failed = F.col("returncode") != 0
    success = F.min(F.when(~failed, F.col("attempt")))
    wait = F.when(failed & (F.col("attempt") < max_attempts), F.col("attempt") * BACKOFF_SECONDS)
    return (
        attempts.groupBy("run")
        .agg(
            F.count(F.lit(1)).alias("n_attempts"),
            success.alias("first_success"),
            F.max_by("returncode", "attempt").alias("_last"),
            F.coalesce(F.sum(wait), F.lit(0)).cast("long").alias("wait_seconds"),
        )
        .withColumn("returncode", F.when(F.col("first_success").isNotNull(), 0).otherwise(F.col("_last")))
        .select("run", "n_attempts", "first_success", "returncode", code_meaning(F.col("returncode")).alias("meaning"), "wait_seconds")
    )


def fingerprint(*parts: Column) -> Column:
    """SHA-256 over the source version and the parameters of a preparation."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]), 256)


def not_prepared(requests: DataFrame, manifest: DataFrame) -> DataFrame:
    """Requests whose fingerprint is not in the manifest of finished preparations."""
    return requests.join(manifest.select("fingerprint"), "fingerprint", "left_anti")
