"""Checkpoints, adapters and the artefact to serve.

Input rows are files: `dir, file`, and `mtime` where it matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import artifact_path, resume_candidates
from ..session import stored

# File names that make a directory a checkpoint, and the state file.
WEIGHT_FILES = [
    "pytorch_model.bin",
    "adapter_model.bin",
    "adapter_model.safetensors",
    "model.safetensors",
    "pytorch_model.safetensors",
]
STATE_FILE = "trainer_state.json"


def valid_checkpoints(files: DataFrame) -> DataFrame:
    weights = files.where(F.col("file").isin(WEIGHT_FILES)).select("dir")
    # Nearly all directories differ: they are shuffled first, not gathered in tables of the scanning tasks.
    return weights.repartition("dir").distinct()


def _options(dir_: Column, file: Column) -> Column:
    """What a file makes of its directory and of the one above: an array of `target, choice, step, dir`.

    `dir` is null where the target stands for itself.
    """
    name, ok = F.substring_index(dir_, "/", -1), file.isin(WEIGHT_FILES)
    step = F.coalesce(F.substring_index(name, "-", -1).try_cast("long"), F.lit(-1))
    above = F.when(F.contains(dir_, F.lit("/")), F.left(dir_, F.length(dir_) - F.length(name) - 1)).otherwise(dir_)

    def option(allowed: Column, target: Column, choice: int, step: Column, below: Column) -> Column:
        fields = target.alias("target"), F.lit(choice).alias("choice"), step.alias("step"), below.alias("dir")
        return F.when(allowed, F.struct(*fields))

    zero, itself = F.lit(0).cast("long"), F.lit(None).cast("string")
    return F.array(
        option(ok, dir_, 0, zero, itself),
        option(ok & name.startswith("checkpoint-"), above, 1, step, dir_),
        option(file == STATE_FILE, dir_, 2, zero, itself),
    )


def _best(options: DataFrame) -> DataFrame:
    """`target, checkpoint`: each target's first choice, then its highest step, then its last directory.

    The options are shuffled by target as they are and sorted once, which spills: few targets repeat inside a scanning task.
    """
    best = F.max(F.struct((-F.col("choice")).alias("choice"), "step", "dir"))
    found = options.repartition("target").groupBy("target").agg(best.alias("_best"))
    return found.select("target", F.coalesce("_best.dir", "target").alias("checkpoint"))


def locate_checkpoints(files: DataFrame) -> DataFrame:
    """`target, checkpoint` for every directory that resolves to one; files may be listed repeatedly.

    The directory itself when it holds weights, else its `checkpoint-N` with
    the highest N, else itself when it holds the trainer state.
    """
    telling = files.where(F.col("file").isin(*WEIGHT_FILES, STATE_FILE))
    return _best(telling.select(F.inline(F.array_compact(_options(F.col("dir"), F.col("file"))))))


def latest_adapter(adapters: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The adapter changed last; of several at one time the last by path."""
    last = F.max_by("path", F.struct("mtime", "path"))
    return adapters.groupBy(*(by or [])).agg(last.alias("path"), F.max("mtime").alias("mtime"))


def resolve_resume(requests: DataFrame, files: DataFrame, cwd: str = "/app") -> DataFrame:
    """`request_id, requested, checkpoint, status` for `request_id, requested, default_path`.

    The first candidate path that is a file or resolves to a checkpoint wins.
    """
    tried = resume_candidates(F.col("requested"), F.col("default_path"), cwd)
    # The outer form keeps the optimizer from repeating the path expression in a filter of its own.
    candidates = stored(requests.select("request_id", F.posexplode_outer(tried).alias("rank", "target")), "candidates")
    # A file stands for itself, a directory for the checkpoint it resolves to.
    path, zero, itself = F.concat_ws("/", "dir", "file"), F.lit(0).cast("long"), F.lit(None).cast("string")
    plain = F.struct(path.alias("target"), F.lit(-1).alias("choice"), zero.alias("step"), itself.alias("dir"))
    options = F.concat(F.array(plain), F.array_compact(_options(F.col("dir"), F.col("file"))))
    targets = _best(files.select(F.inline(options)))
    found = candidates.join(targets, "target").select("request_id", "rank", "checkpoint").repartition("request_id")
    found = found.groupBy("request_id").agg(F.min_by("checkpoint", "rank").alias("checkpoint"))
    status = (
        F.when(F.coalesce(F.col("requested"), F.lit("")).isin("", "null"), "not_requested")
        .when(F.col("checkpoint").isNull(), "not_found")
        .otherwise("resolved")
    )
    return requests.join(found, "request_id", "left").select("request_id", "requested", "checkpoint", status.alias("status"))


def served_artifact(runs: DataFrame, directories_there: DataFrame, suffix: str = "awq") -> DataFrame:
    """`run, served_path, source` for `run, override, prefer_quantised`; `directories_there` has `path`.

    An override wins, then the quantised directory where it exists and is preferred, else the merged one.
    """
    override = F.trim(F.coalesce(F.col("override"), F.lit("")))
    merged = F.concat(F.col("run"), F.lit("/merged"))
    there = directories_there.select(F.col("path").alias("_quantised")).distinct().withColumn("_there", F.lit(True))
    joined = runs.withColumn("_quantised", F.concat(merged, F.lit(f"_{suffix}"))).join(there, "_quantised", "left")
    overridden = (F.col("override") != "") & (F.lower(override) != "none")
    quantised = F.col("prefer_quantised") & F.coalesce(F.col("_there"), F.lit(False))
    return joined.select(
        "run",
        F.when(overridden, artifact_path(F.col("override")))
        .when(quantised, F.col("_quantised"))
        .otherwise(merged)
        .alias("served_path"),
        F.when(overridden, "override").when(quantised, suffix).otherwise("merged").alias("source"),
    )
