"""Checks on generated texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, token_count


def language_pass(detected: Column, wanted: Column, strict: bool = False) -> Column:
    """By default only the first letter of the wanted code counts; no wanted code passes."""
    want = F.lower(wanted)
    hit = F.lower(detected) == want if strict else F.startswith(F.lower(detected), F.substring(want, 1, 1))
    return F.when(F.coalesce(wanted, F.lit("")) == "", True).otherwise(hit)


def sentence_count(text: Column) -> Column:
    """Non-blank parts between full stops."""
    return F.size(F.filter(F.split(text, "[.]", -1), lambda part: ~is_blank(part)))


def length_pass(generation: Column, max_sentences: Column) -> Column:
    """No limit, and a limit of 0, passes."""
    limit = F.coalesce(max_sentences, F.lit(0))
    return F.when(limit == 0, True).otherwise(sentence_count(generation) <= limit)


def check_prompts(results: DataFrame, detected: DataFrame, keys: list[str], strict: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Prompt results with both checks and token totals, and the columns of `results` named in `keep`.

    `results`: keys, instruction, generation, wanted, max_sentences, prompt_text.
    `detected`: keys, language. `tokens` counts prompt and generation.
    """
    new_tokens = token_count(F.col("generation"))
    language = F.when(F.col("generation") == "", "unknown").otherwise(F.col("language"))
    return results.join(detected, keys, "left").select(
        *keys,
        *(keep or []),
        "instruction",
        "generation",
        language_pass(language, F.col("wanted"), strict).alias("language_pass"),
        length_pass(F.col("generation"), F.col("max_sentences")).alias("length_pass"),
        (token_count(F.col("prompt_text")) + new_tokens).alias("tokens"),
        new_tokens.alias("new_tokens"),
    )


def eval_summary(checked: DataFrame) -> DataFrame:
    """Counts and pass rates over all prompts; the prompt results stay a table."""
    both = F.col("language_pass") & F.col("length_pass")
    return checked.agg(
        F.count(F.lit(1)).alias("n_prompts"),
        F.count_if("language_pass").alias("n_language_pass"),
        F.count_if("length_pass").alias("n_length_pass"),
        F.count_if(both).alias("n_pass"),
        F.avg(F.col("language_pass").cast("int")).alias("language_pass_rate"),
        F.avg(F.col("length_pass").cast("int")).alias("length_pass_rate"),
        F.max("tokens").alias("max_tokens"),
        F.sum("new_tokens").alias("sum_new_tokens"),
    )


def worst_cases(checked: DataFrame, k: int, by: str, keys: list[str], parts: int = 64) -> DataFrame:
    """`by, rank` and the other columns of `checked` for the `k` worst prompts of each language or other group `by`.

    Worse is: fewer checks passed, then more tokens made, then the smaller keys. Each of `parts` parts of a language
    gives its `k` worst first, so no language is gathered whole.
    """
    passed = F.coalesce(F.col("language_pass").cast("int"), F.lit(0)) + F.coalesce(F.col("length_pass").cast("int"), F.lit(0))
    order = [F.asc("_passed"), F.desc_nulls_last("new_tokens"), *map(F.asc, keys)]
    rows = checked.withColumn("_passed", passed).withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts)))
    some = rows.withColumn("_r", F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order))).where(F.col("_r") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select(by, "rank", *[c for c in checked.columns if c != by])


def generate(
    prompts: DataFrame,
    infer_fn: Callable[[Iterator[pd.Series]], Iterator[pd.Series]],
    prompt: str = "prompt_text",
    output: str = "generation",
) -> DataFrame:
    """Add what a model answers. `infer_fn` sees batches of prompts and loads its model once per task."""
    schema = prompts.withColumn(output, F.lit("")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def texts() -> Iterator[pd.Series]:
            for batch in batches:
                held.append(batch)
                yield batch[prompt]

        for answer in infer_fn(texts()):
            batch = held.pop(0)
            yield batch.assign(**{output: answer.str.strip().to_numpy()})

    return prompts.mapInPandas(run, schema)
