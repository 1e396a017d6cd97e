"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for. AQE splits skewed join partitions and
# picks broadcast joins from measured sizes; everything else is Spark's default.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tuneweave", **overrides: str) -> SparkSession:
    """Create or get a session with the settings above; `overrides` win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def configured_root(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by `spark.checkpoint.dir`.

    A local session without the setting gets a folder of its own; a cluster
    without it is an error, since a folder on one machine is not shared.
    """
    root = configured_root(spark)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tuneweave-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that no other job uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the scratch folder and read back: computed once, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
