"""The preparation job: filter, sample, template, cutoff, split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import instruction_turns, render_turns
from ..functions.hashing import split_label
from ..functions.text import cutoff, is_blank, token_count
from ..functions.tokenizers import Load, cut_text
from ..operators.conversations import conversation_texts, render_conversations
from ..operators.sampling import sample_n
from ..params import PrepareParams
from ..session import stored
from ..sources.tables import filter_language


def prepare_instructions(corpus: DataFrame, params: PrepareParams, tokenizer: Load | None = None) -> DataFrame:
    """`id, text, n_tokens, was_cut, split` from `id, instruction, input, output, lang`.

    After the sample everything is row-local. Without a `tokenizer` tokens are
    runs of non-space characters.
    """
    sampled = sample_n(_wanted(corpus, params), params.sample_size, "id", params.seed)
    return _rendered(sampled, params, tokenizer)


def _wanted(corpus: DataFrame, params: PrepareParams) -> DataFrame:
    return filter_language(corpus, params.languages).where(~is_blank(F.col("output")))


def prepare_rows(corpus: DataFrame, params: PrepareParams, tokenizer: Load | None = None) -> DataFrame:
    """The row-local part, for all rows whatever the sample size; also runs on a stream."""
    return _rendered(_wanted(corpus, params), params, tokenizer)


def _rendered(kept: DataFrame, params: PrepareParams, tokenizer: Load | None) -> DataFrame:
    pair = instruction_turns(F.col("instruction"), F.col("input"), F.col("output"))
    text = render_turns(params.template, pair, params.eos, params.bos)
    return _finish(kept.select("id", text.alias("text")), params, tokenizer)


def _finish(texts: DataFrame, params: PrepareParams, tokenizer: Load | None) -> DataFrame:
    n, limit = F.col("n_tokens"), params.cutoff_len
    if tokenizer is None:
        counted = texts.withColumn("n_tokens", token_count(F.col("text")))
        text = cutoff(F.col("text"), limit, n)
    else:
        counted = texts.withColumn("_cut", cut_text(F.col("text"), tokenizer, limit)).select("id", "_cut.*")
        text = F.col("text")
    return counted.select(
        "id",
        text.alias("text"),
        F.least(n, F.lit(limit)).alias("n_tokens"),
        (n > limit).alias("was_cut"),
        split_label(F.col("id"), params.test_size, params.seed).alias("split"),
    )


def prepare_chat(turns: DataFrame, params: PrepareParams, tokenizer: Load | None = None) -> DataFrame:
    """`conv_id, text, n_tokens, was_cut, split` from chat turns.

    Languages filter by a `lang` column of the turns, the same all through a conversation. The
    sample is one of conversations.
    """
    wanted = filter_language(turns, params.languages)
    if params.sample_size is not None:
        ids = stored(wanted.select("conv_id").distinct(), "conversations")
        wanted = wanted.join(sample_n(ids, params.sample_size, "conv_id", params.seed), "conv_id", "left_semi")
    if tokenizer is None:
        texts = conversation_texts(wanted, params.template, params.cutoff_len, params.eos, params.bos)
        return texts.withColumn("split", split_label(F.col("conv_id"), params.test_size, params.seed))
    whole = render_conversations(wanted, params.template, params.eos, params.bos)
    done = _finish(whole.select(F.col("conv_id").alias("id"), "text"), params, tokenizer)
    return done.withColumnRenamed("id", "conv_id")


def prepare_and_count(corpus: DataFrame, params: PrepareParams, tokenizer: Load | None = None) -> tuple[DataFrame, Observation]:
    """`prepare_instructions` and the figures of `preprocess_summary`, counted by the pass that reads the corpus.

    The observation has its values after the first action on the rows; see `observed_summary`. It counts
    the rows read and kept and the languages of those kept.
    """
    figures = Observation("preprocess")
    kept = ~is_blank(F.col("output"))
    if params.languages is not None:
        kept = kept & F.col("lang").isin([code.lower() for code in params.languages])
    lang = F.col("lang") if "lang" in corpus.columns else F.lit(None).cast("string")
    counted = corpus.observe(
        figures,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(kept, F.lit(False))).alias("n_kept"),
        F.array_sort(F.collect_set(F.when(kept, lang))).alias("kept_languages"),
    )
    return prepare_instructions(counted, params, tokenizer), figures


def observed_summary(spark: SparkSession, figures: Observation, params: PrepareParams) -> DataFrame:
    """The row of `preprocess_summary` from an observation."""
    found = figures.get
    size = found["n_kept"] if params.sample_size is None else min(found["n_kept"], params.sample_size)
    row = (size, found["kept_languages"], found["n"] - found["n_kept"], params.seed)
    return spark.createDataFrame([row], "sample_size long, kept_languages array<string>, discarded long, seed long")


def preprocess_summary(corpus: DataFrame, params: PrepareParams, text: str = "output") -> DataFrame:
    """Rows in, kept and discarded, the languages kept and the seed, in one pass."""
    kept = ~is_blank(F.col(text))
    if "lang" not in corpus.columns:
        corpus = filter_language(corpus, params.languages).withColumn("lang", F.lit(None).cast("string"))
    if params.languages is not None:
        kept = kept & F.col("lang").isin([code.lower() for code in params.languages])
    per_lang = corpus.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(kept).alias("n_kept"))
    n_kept = F.coalesce(F.sum("n_kept"), F.lit(0))
    size = n_kept if params.sample_size is None else F.least(n_kept, F.lit(params.sample_size))
    return per_lang.agg(
        size.cast("long").alias("sample_size"),
        F.array_sort(F.collect_set(F.when(F.col("n_kept") > 0, F.col("lang")))).alias("kept_languages"),
        F.coalesce(F.sum(F.col("n") - F.col("n_kept")), F.lit(0)).alias("discarded"),
        F.lit(params.seed).cast("long").alias("seed"),
    )
