"""Queries over language detection, scoring and prompt checks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chat import prompt_messages, render_messages
from ..functions.hashing import split_label
from ..operators import evaluation, language, scoring
from ..operators.conversations import turn_pairs
from ..session import stored
from ..sources.tables import table
from .corpus_queries import EOS, SEED, SQL_PAIRS, TEST_SIZE, documents, sql_count, sql_qwen, sql_split, sql_trim, turns

CODES = ["de", "en", "es", "fr"]


def train_split(spark, folder) -> DataFrame:
    return documents(spark, folder).where(split_label(F.col("doc_id"), TEST_SIZE, SEED) == "train")


def profile(spark, folder) -> DataFrame:
    return stored(language.language_profile(train_split(spark, folder), CODES), "profile")


def detected(spark, folder):
    return language.detect_language(documents(spark, folder), profile(spark, folder), CODES, ["doc_id"])


def raw_scores(spark, folder) -> DataFrame:
    vocab = stored(scoring.vocabulary(train_split(spark, folder)), "vocabulary")
    return scoring.unigram_scores(documents(spark, folder), vocab, "doc_id")


def scores(spark, folder):
    return raw_scores(spark, folder).withColumn("loss", F.round("loss", 6))


def corpus_perplexity(spark, folder):
    langs = documents(spark, folder).select("doc_id", "lang")
    by_lang = scoring.perplexity(raw_scores(spark, folder).join(langs, "doc_id"), ["lang"])
    return by_lang.withColumn("perplexity", F.round("perplexity", 4))


def model_scores(spark, folder):
    # Models are inner functions, which Spark ships whole to its workers.
    def score_by_length(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A model of known answers: the loss is one over the token count."""
        for batch in batches:
            n = batch["text"].str.split().str.len()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": n, "loss": 1.0 / n.where(n > 1)})

    found = scoring.score_texts(documents(spark, folder).select("doc_id", "text"), score_by_length, "doc_id")
    return found.withColumn("loss", F.round("loss", 9))


def prompt_results(spark, folder) -> DataFrame:
    wanted = F.element_at(F.array(F.lit("EN"), F.lit("fr"), F.lit(""), F.lit(None)), (F.col("conv_id") % 4 + 1).cast("int"))
    limit = F.element_at(F.array(F.lit(None), F.lit(0), F.lit(3)), (F.col("turn") % 3 + 1).cast("int"))
    messages = prompt_messages(F.col("instruction"))
    return turn_pairs(turns(spark, folder)).select(
        "conv_id",
        "turn",
        "instruction",
        F.col("output").alias("generation"),
        wanted.alias("wanted"),
        limit.alias("max_sentences"),
        render_messages("qwen", messages, EOS).alias("prompt_text"),
    )


def checked(spark, folder):
    results = prompt_results(spark, folder)
    keys = ["conv_id", "turn"]
    languages = language.detect_language(results, profile(spark, folder), CODES, keys, "generation")
    return evaluation.check_prompts(results, languages, keys)


def check_summary(spark, folder):
    found = evaluation.eval_summary(checked(spark, folder))
    return found.withColumn("language_pass_rate", F.round("language_pass_rate", 6)).withColumn(
        "length_pass_rate", F.round("length_pass_rate", 6)
    )


WORST = 3


def worst(spark, folder):
    """The worst prompts of each wanted language."""
    results, keys = prompt_results(spark, folder), ["conv_id", "turn"]
    results = results.withColumn("asked_for", F.coalesce(F.nullif("wanted", F.lit("")), F.lit("any")))
    languages = language.detect_language(results, profile(spark, folder), CODES, keys, "generation")
    found = evaluation.worst_cases(evaluation.check_prompts(results, languages, keys, keep=["asked_for"]), WORST, "asked_for", keys)
    return found.select("asked_for", "rank", *keys, "language_pass", "length_pass", "tokens", "new_tokens")


def generated(spark, folder):
    def answer_length(prompts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """A model of known answers: how long the prompt is."""
        for batch in prompts:
            yield " length " + batch.str.len().astype(str) + "\n"

    rows = table(spark, folder, "benchmark").select(
        "item_id", render_messages("qwen", prompt_messages(F.col("text")), EOS).alias("prompt_text")
    )
    return evaluation.generate(rows, answer_length)


QUERIES = {
    "detect_language": detected,
    "unigram_scores": scores,
    "perplexity": corpus_perplexity,
    "model_scores": model_scores,
    "eval_prompts": checked,
    "eval_summary": check_summary,
    "eval_worst": worst,
    "batch_generate": generated,
}


def sql_grams(text: str) -> str:
    words = rf"'_' || regexp_replace(lower({text}), '[^\p{{L}}]+', '_', 'g') || '_'"
    parts = [f"regexp_extract_all(({words})[{i}:], '...')" for i in (1, 2, 3)]
    return f"list_filter(list_concat(list_concat({parts[0]}, {parts[1]}), {parts[2]}), lambda g: g[2] <> '_')"


def sql_detect(rows: str, keys: str, text: str) -> str:
    """SQL twin of profile and detection over `rows`."""
    sums = ", ".join(f"coalesce(sum(w) filter (lang = '{code}'), 0) as w_{code}" for code in CODES)
    best = "greatest(" + ", ".join(f"w_{code}" for code in CODES) + ")"
    cases = " ".join(f"when w_{code} = {best} then '{code}'" for code in sorted(CODES))
    return f"""(with counts as (
        select lang, gram, count(*) as n from (
          select lang, unnest({sql_grams('text')}) as gram from documents where {sql_split('doc_id')} = 'train')
        group by all),
      ranked as (select *, sum(n) over (partition by lang) as total from counts),
      weights as (select gram, lang, round(1000 * ln(1 + n * 100000.0::double / total))::bigint as w
        from ranked),
      hits as (select {keys}, unnest({sql_grams(text)}) as gram from ({rows})),
      sums as (select {keys}, {sums} from hits join weights using (gram) group by all)
      select {keys}, case when {best} = 0 then 'unknown' {cases} end as language from sums)"""


SQL_WORDS = r"""select doc_id, unnest(regexp_extract_all(text, '\S+')) as token,
  generate_subscripts(regexp_extract_all(text, '\S+'), 1) as pos from documents"""
SQL_SCORES = rf"""(with vocab as (
    select token, count(*) as n from (
      select unnest(regexp_extract_all(text, '\S+')) as token from documents where {sql_split('doc_id')} = 'train') group by 1),
  size as (select sum(n) + count(*) + 1 as t from vocab)
  select doc_id, count(*) as n_tokens,
    avg(ln((select t from size)::double) - ln(coalesce(n, 0) + 1)) filter (pos > 1) as loss
  from ({SQL_WORDS}) left join vocab using (token) group by 1)"""

SQL_RESULTS = f"""select conv_id, turn, instruction, output as generation,
    [ 'EN', 'fr', '', null ][conv_id % 4 + 1] as wanted, [null, 0, 3][turn % 3 + 1] as max_sentences,
    {sql_qwen("'system'", "'You are a helpful assistant.'", '0')} || {sql_qwen("'user'", 'instruction', '1')} as prompt_text
  from ({SQL_PAIRS})"""
SQL_CHECKED = rf"""select conv_id, turn, instruction, generation,
    case when coalesce(wanted, '') = '' then true
      else starts_with(coalesce(language, 'unknown'), lower(wanted)[1]) end as language_pass,
    case when coalesce(max_sentences, 0) = 0 then true
      else len(list_filter(string_split(generation, '.'), lambda part: regexp_matches(part, '\S'))) <= max_sentences end as length_pass,
    {sql_count('prompt_text')} + {sql_count('generation')} as tokens, {sql_count('generation')} as new_tokens
  from ({SQL_RESULTS}) left join {sql_detect(SQL_RESULTS, 'conv_id, turn', 'generation')} using (conv_id, turn)"""

ORACLE = {
    "detect_language": f"""select doc_id, coalesce(language, 'unknown') as language from documents
      left join {sql_detect('documents', 'doc_id', 'text')} using (doc_id)""",
    "unigram_scores": f"select doc_id, n_tokens, round(loss, 6) as loss from {SQL_SCORES}",
    "perplexity": f"""select lang, round(exp(sum(loss * n_tokens) / sum(n_tokens) filter (loss is not null)), 4) as perplexity,
        (coalesce(sum(n_tokens) filter (loss is not null), 0))::bigint as n_tokens,
        count(loss) as n_texts, count(*) - count(loss) as n_unscored
      from {SQL_SCORES} join documents using (doc_id) group by 1""",
    "model_scores": f"""select doc_id, {sql_count('text')} as n_tokens,
      case when {sql_count('text')} > 1 then round(1.0::double / {sql_count('text')}, 9) end as loss from documents""",
    "eval_prompts": SQL_CHECKED,
    "eval_summary": f"""select count(*) as n_prompts, count(*) filter (language_pass) as n_language_pass,
        count(*) filter (length_pass) as n_length_pass, count(*) filter (language_pass and length_pass) as n_pass,
        round(avg(language_pass::int), 6) as language_pass_rate, round(avg(length_pass::int), 6) as length_pass_rate,
        max(tokens) as max_tokens, sum(new_tokens)::bigint as sum_new_tokens from ({SQL_CHECKED})""",
    "eval_worst": f"""select asked_for, row_number() over (partition by asked_for order by passed, new_tokens desc, conv_id, turn)::int as rank,
        conv_id, turn, language_pass, length_pass, tokens, new_tokens
      from (select *, case conv_id % 4 when 0 then 'EN' when 1 then 'fr' else 'any' end as asked_for,
        language_pass::int + length_pass::int as passed from ({SQL_CHECKED})) qualify rank <= {WORST}""",
    "batch_generate": f"""select item_id, prompt_text, 'length ' || length(prompt_text) as generation from (
      select item_id, {sql_qwen("'system'", "'You are a helpful assistant.'", '0')} || {sql_qwen("'user'", 'text', '1')} as prompt_text
      from benchmark)""",
}
