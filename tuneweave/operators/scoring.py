"""Per-text loss and corpus perplexity."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import stored

# A token that is more than one in this many is frequent; there are fewer than this many of them.
FREQUENT = 10_000
# Parts that the texts are dealt into where they are joined with the other tokens.
SALTS = 16


def vocabulary(train: DataFrame, text: str = "text") -> DataFrame:
    """`token, n`; counts are added up before the shuffle."""
    words = train.select(F.explode(tokens(F.col(text))).alias("token"))
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def unigram_scores(df: DataFrame, vocab: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`key, n_tokens, loss` under an add-one unigram model.

    The loss is the mean over the tokens that have one before them, as for a
    causal model; texts of one token have no such token and a null loss. Empty
    texts give no row.

    Tokens that make up more than 1/10,000 of the corpus number under 10,000
    and are looked up by broadcast. The others are joined by token and one of `SALTS` parts
    of the texts, so that a token common only in the scored texts does not go to one task.
    """
    vocab = stored(vocab, "vocabulary")
    total, kinds = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    model = vocab.select("token", "n", (F.col("n") * FREQUENT > total).alias("_frequent"))
    frequent = F.broadcast(model.where("_frequent").select("token", "n"))
    parts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    rare = model.where(~F.col("_frequent")).select("token", "n", F.explode(parts).alias("_salt"))
    cost = F.lit(math.log(total + kinds + 1)) - F.log(F.coalesce(F.col("n"), F.lit(0)) + 1)

    words = df.select(key, tokens(F.col(text)).alias("_words")).where(F.size("_words") > 0)
    rest = F.slice("_words", F.lit(2), F.size("_words"))
    each = words.select(key, F.size("_words").cast("long").alias("n_tokens"), F.explode_outer(rest).alias("token"))
    # The frequent tokens of a text are summed where the text is; only the others are shuffled.
    hit = F.col("n").isNotNull()
    near = each.join(frequent, "token", "left").groupBy(key).agg(
        F.max("n_tokens").alias("n_tokens"), F.sum(F.when(hit, cost)).alias("cost"), F.count_if(hit).alias("times")
    )
    others = each.where("token is not null").join(frequent, "token", "left_anti").select(key, "token")
    salted = others.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    far = salted.join(rare, ["token", "_salt"], "left").groupBy(key).agg(
        F.lit(None).cast("long").alias("n_tokens"), F.sum(cost).alias("cost"), F.count(F.lit(1)).alias("times")
    )
    sums = near.unionByName(far).groupBy(key)
    loss = F.sum("cost") / F.nullif(F.sum("times"), F.lit(0))
    return sums.agg(F.max("n_tokens").alias("n_tokens"), loss.alias("loss"))


def score_texts(
    df: DataFrame, score_fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], key: str
) -> DataFrame:
    """`key, n_tokens, loss` from a model; `score_fn` loads it once per task."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, n_tokens long, loss double"
    return df.mapInPandas(score_fn, schema)


def perplexity(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """`exp(sum(loss * n) / sum(n))`; null without tokens. Texts without a loss are counted apart."""
    scored = F.col("loss").isNotNull()
    n = F.when(scored, F.col("n_tokens"))
    return scores.groupBy(*(by or [])).agg(
        F.exp(F.sum(F.col("loss") * n) / F.nullif(F.sum(n), F.lit(0))).alias("perplexity"),
        F.coalesce(F.sum(n), F.lit(0)).alias("n_tokens"),
        F.count_if(scored).alias("n_texts"),
        F.count_if(~scored).alias("n_unscored"),
    )
