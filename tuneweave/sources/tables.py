"""Corpus readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Output column -> type of an instruction corpus.
INSTRUCTION_COLUMNS = {"id": "long", "instruction": "string", "input": "string", "output": "string", "lang": "string"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on a table with fewer file splits than cores; larger ones stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_instructions(source: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Map a corpus to `id, instruction, input, output, lang` by SQL expressions.

    Columns left out are null, but `lang`, which is then not there: a language filter refuses such a corpus.
    """
    unknown = set(mapping) - set(INSTRUCTION_COLUMNS)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    return source.select(
        *[
            F.expr(mapping.get(name, "null")).cast(kind).alias(name)
            for name, kind in INSTRUCTION_COLUMNS.items()
            if name != "lang" or name in mapping
        ]
    )


def filter_language(df: DataFrame, languages: list[str] | None, lang: str = "lang") -> DataFrame:
    """Rows of the allowed languages; the codes are lower-cased here so that the filter reaches the scan."""
    if languages is None:
        return df
    if not languages:
        raise ValueError("the language list is empty; pass None for no filter")
    if lang not in df.columns:
        raise ValueError(f"no column {lang} to filter by: map one, detect the language, or pass None for no filter")
    return df.where(F.col(lang).isin([code.lower() for code in languages]))
