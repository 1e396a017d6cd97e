"""Language detection by character trigrams.

A naive Bayes score in whole numbers: every trigram of a text adds a weight per
language, and the language with the largest sum wins. Weights come from a
labelled corpus. Scores are sums, so a text's trigrams are scored and added up
in the task that reads the text; what is shuffled is one row per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the code for texts without any known trigram.
UNKNOWN = "unknown"

WEIGHT_SCALE = 1000
RARITY = 100_000


def words(text: Column) -> Column:
    """The letters of a text, lower-cased, with a `_` before, between and after words."""
    letters = F.regexp_replace(F.lower(text), r"[^\p{L}]+|[\x{10000}-\x{10FFFF}]", "_")
    return F.concat(F.lit("_"), letters, F.lit("_"))


def trigrams(padded: Column) -> Column:
    """All trigrams inside words and at their ends. One pass over the text."""
    return F.regexp_extract_all(padded, F.lit("(?=(.[^_].))"), F.lit(1))


def language_profile(
    corpus: DataFrame, languages: list[str], text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per trigram with a weight column per language.

    All trigrams count. Words are counted first, so trigrams are cut from
    distinct words only.
    """
    labelled = corpus.where(F.col(lang).isin(languages))
    spelled = labelled.select(lang, F.explode(F.split(words(F.col(text)), "_")).alias("word"))
    counted = spelled.where(F.col("word") != "").groupBy(lang, "word").agg(F.count(F.lit(1)).alias("n"))
    padded = F.concat(F.lit("_"), F.col("word"), F.lit("_"))
    grams = counted.select(lang, "n", F.explode(trigrams(padded)).alias("gram"))
    counts = grams.groupBy(lang, "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy(lang).agg(F.sum("n").alias("total"))
    weight = F.round(WEIGHT_SCALE * F.log(1 + F.col("n") * F.lit(float(RARITY)) / F.col("total"))).cast("long")
    weighted = counts.join(F.broadcast(totals), lang).select("gram", lang, weight.alias("w"))
    return weighted.groupBy("gram").agg(
        *[F.coalesce(F.sum(F.when(F.col(lang) == code, F.col("w"))), F.lit(0)).alias(f"w_{code}") for code in languages]
    )


def detect_language(
    df: DataFrame, profile: DataFrame, languages: list[str], keys: list[str], text: str = "text"
) -> DataFrame:
    """`keys, language`; ties go to the first code in order, texts without a hit are `unknown`."""
    grams = df.select(*keys, F.explode_outer(trigrams(words(F.col(text)))).alias("gram"))
    scored = grams.join(profile, "gram", "left")
    sums = scored.groupBy(*keys).agg(*[F.sum(f"w_{code}").alias(f"w_{code}") for code in languages])
    best = F.greatest(*[F.coalesce(F.col(f"w_{code}"), F.lit(0)) for code in languages])
    chosen = F.lit(UNKNOWN)
    for code in sorted(languages, reverse=True):
        chosen = F.when(F.col(f"w_{code}") == best, code).otherwise(chosen)
    return sums.select(*keys, F.when(best > 0, chosen).otherwise(UNKNOWN).alias("language"))
