"""Corpus pipeline: quality rules, language identification, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns of their docs.
Rows with a null text go in the first stage, as they have no words. Rows without an id
are never duplicates. Repeated ids that reach the third stage keep one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tuneweave.llm import language_id, ngram_join, packing, quality
from tuneweave.llm.common import table
from tuneweave.llm.queries import vocabulary
from tuneweave.session import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or score below the threshold against this stage's own input."""
    ratios = quality.log_ratios(docs, table(spark, sf_dir, "labels"))
    return quality.kept(docs, ratios)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identifiable language."""
    model = language_id.fit(docs.where(~language_id.held_out("doc_id")))
    return language_id.identified(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component: five-word shingles, similarity 0.8."""
    found = ngram_join.join(docs.select("doc_id", "text"))
    kept = stored(found.where("component_id = doc_id").select("doc_id").distinct(), "kept")
    chosen = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return docs.where("doc_id is null").unionByName(chosen)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens."""
    path = vocabulary("byte_bpe_50k.json")
    return packing.pack(docs, lambda: packing.load_tokenizer(path))


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("packing", packing_stage),
]

# Models, tokenizers and components are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
