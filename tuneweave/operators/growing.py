"""An exact seeded sample of a corpus that grows, kept from version to version.

The sample of `n` rows is the `n` smallest `(hash, key)` of all rows so far, so that of a
union is among the samples of its parts: each increment is merged with the keys kept before, and
no earlier text is read again. A folder holds for each version

* `keys/version=v`: the hashes and keys of the sample, at most `n` rows,
* `rows/version=v`: the rows of the increment that entered, with all their columns.

and the table `versions` of those that are written whole. Writing a version again replaces it, so
a replayed increment changes nothing. A key that comes again keeps its first row. Rows
without a key take no part. Rows that left stay in the folder of their version.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import order_hash
from ..session import stored
from .sampling import sample_n, split_exact

HASH = "_hash"


class GrowingSample:
    def __init__(self, spark: SparkSession, folder: str, n: int, key: str, seed: int):
        if n <= 0:
            raise ValueError("n must be positive")
        self.spark, self.folder, self.n, self.key, self.seed = spark, folder, n, key, seed

    def versions(self) -> list[int]:
        """Versions written whole, oldest first."""
        try:
            found = self.spark.read.schema("version long").parquet(f"{self.folder}/versions")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r["version"] for r in found.distinct().collect())

    def keys(self, version: int | None = None) -> DataFrame:
        """Hashes and keys of the sample at a version, by default the last."""
        known = self.versions()
        version = known[-1] if version is None and known else version
        if version not in known:
            raise ValueError(f"no version {version} in {self.folder}")
        return self.spark.read.parquet(f"{self.folder}/keys/version={version}")

    def add(self, increment: DataFrame, version: int) -> None:
        """Merge new rows into the sample; `version` grows from increment to increment."""
        key = F.col(self.key)
        before = [v for v in self.versions() if v < version]
        fresh = increment.where(key.isNotNull()).withColumn(HASH, order_hash(key, self.seed, "sample"))
        if before:
            kept = self.keys(before[-1])
            size, last = kept.agg(F.count(F.lit(1)), F.max(F.struct(HASH, self.key))).first()
            if size >= self.n:
                # A full sample lets nothing past its last row: this is a filter of the scan.
                fresh = fresh.where(F.struct(F.col(HASH), key) < F.struct(F.lit(last[0]), F.lit(last[1]).cast(increment.schema[self.key].dataType)))
            fresh = fresh.join(kept.select(self.key), self.key, "left_anti")
            names = kept.select(HASH, self.key)
        else:
            names = None
        new = stored(fresh.select(HASH, self.key).distinct(), "new-keys")
        names = new if names is None else names.unionByName(new)
        path = f"{self.folder}/keys/version={version}"
        sample_n(names, self.n, self.key, self.seed).select(HASH, self.key).write.mode("overwrite").parquet(path)
        chosen = self.spark.read.parquet(path).select(self.key)
        entered = fresh.join(chosen, self.key, "left_semi").drop(HASH).dropDuplicates([self.key])
        entered.write.mode("overwrite").parquet(f"{self.folder}/rows/version={version}")
        if version not in self.versions():
            self.spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{self.folder}/versions")

    def rows(self) -> DataFrame:
        """The rows of the sample at its last version."""
        found = self.spark.read.parquet(*[f"{self.folder}/rows/version={v}" for v in self.versions()])
        return found.join(self.keys().select(self.key), self.key, "left_semi").select(found.columns)

    def changes(self, version: int) -> DataFrame:
        """`key, change` of the keys that `entered` or `left` with a version."""
        before = [v for v in self.versions() if v < version]
        now = self.keys(version).select(self.key, F.lit(True).alias("_now"))
        old = (self.keys(before[-1]) if before else self.keys(version).limit(0)).select(self.key, F.lit(True).alias("_old"))
        both = now.join(old, self.key, "full").where("_now is null or _old is null")
        return both.select(self.key, F.when(F.col("_now"), "entered").otherwise("left").alias("change"))

    def splits(self, test_size: float) -> DataFrame:
        """`key, split` with exactly `ceil(rows * test_size)` validation rows of the sample; no text is read."""
        return split_exact(self.keys().select(self.key), test_size, self.key, self.seed)
