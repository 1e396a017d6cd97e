"""One query per operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneweave.llm import (
    ann,
    bpe,
    collocations,
    html_text,
    language_id,
    lexical_search,
    license_scan,
    ngram_join,
    packing,
    quality,
    token_counts,
    token_files,
    url_filter,
)
from tuneweave.llm.common import table

# Rules of the url query: name and verdict.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filter.host_rule(name, verdict) for name, verdict in URL_RULES.items()] + url_filter.WORDS
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), lambda: packing.load_tokenizer(path))


def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.round_trip(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"), license_scan.TEMPLATES)


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    apart = language_id.held_out("doc_id")
    model = language_id.fit(docs.where(~apart))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", apart.alias("held_out"), "lang_pred", "score"
    )


def ann_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.search(vectors, F.col("vec_id") % 20 == 0)


def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    ratios = quality.log_ratios(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, ratios).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def token_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model"))


def ngram_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents", "doc_id", "text"), size=3, percent=90)


def token_file_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = token_files.round_trip(docs, lambda: token_files.load_tokenizer(path))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def collocation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "lang", "text"))


def lexical_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


QUERIES = {
    "op1_url_filter": url_filter_query,
    "op2_packing": packing_query,
    "op3_bpe": bpe_query,
    "op4_license_scan": license_query,
    "op5_language_id": language_query,
    "op6_ann": ann_query,
    "op7_html_text": html_query,
    "op8_quality": quality_query,
    "op9_token_counts": token_count_query,
    "op10_ngram_join": ngram_join_query,
    "op11_token_files": token_file_query,
    "op12_collocations": collocation_query,
    "op13_lexical_search": lexical_query,
}


def _lower(text: str) -> str:
    return f"translate({text}, '{license_scan.UPPER}', '{license_scan.LOWER}')"


def _url_sql() -> str:
    values = ", ".join(f"('{name}', '{verdict}')" for name, verdict in URL_RULES.items())
    words = "|".join(r.name for r in url_filter.WORDS)
    return f"""
with split as (
  select page_id,
         coalesce({_lower("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")}, '') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages
), rules as (
  select rule, verdict, split_part(rule, '/', 1) as host, substr(rule, strpos(rule, '/')) as path
  from (values {values}) as v(rule, verdict)
), fits as (
  select page_id, arg_max(rules.rule, length(rules.rule)) as rule, arg_max(rules.verdict, length(rules.rule)) as verdict
  from split join rules
    on (split.host = rules.host or ends_with(split.host, '.' || rules.host)) and starts_with(split.path, rules.path)
  group by page_id
)
select page_id, host, path, fits.rule as rule,
       coalesce(fits.verdict, case when regexp_matches(host, '(^|[^a-z0-9])({words})($|[^a-z0-9])') then 'block' else 'allow' end) as verdict
from split left join fits using (page_id)
"""


def _license_sql() -> str:
    t = license_scan.THRESHOLD
    names = {n: license_scan.bigrams_of(x) for n, x in sorted(license_scan.TEMPLATES.items())}
    values = ", ".join(f"('{n}', {p!r}::varchar[])" for n, p in names.items())
    return f"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as content, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line
  from documents where text is not null
), words as (
  select doc_id, line, string_split(trim(regexp_replace({_lower("content")}, '[^a-z0-9]+', ' ', 'g')), ' ') as w from lines
), pairs as (
  select doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as p from words where len(w) > 1
), scores as (
  select doc_id, line, license, 2.0::double * len(list_intersect(p, q)) / (len(p) + len(q)) as dice
  from pairs, (values {values}) as v(license, q)
  where len(p) between len(q) * {t / (2 - t)} and len(q) / {t / (2 - t)}
), best as (
  select doc_id, line, arg_max(license, (dice, -ord)) as license, max(dice) as dice
  from (select *, row_number() over (partition by doc_id, line order by license) as ord from scores where dice >= {t}) group by doc_id, line
)
select doc_id, license, count(*) as n_lines, min(line)::int as first_line, max(dice) as dice from best group by doc_id, license
"""


def _collocation_sql() -> str:
    return rf"""
with docs as (
  select coalesce(lang, 'und') as lang, {_lower("coalesce(text, '')")} as text from documents
), pieces as (
  select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from docs
), words as (
  select lang, regexp_extract_all(piece, '[^ \x09]+') as w from pieces
), starts as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from words
), grams as materialized (
  select lang, k as size, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f
  from starts, (values (1), (2), (3)) as v(k) where i + k - 1 <= len(w) group by all
), candidates as (
  select lang, size, phrase, f as a, string_split(phrase, ' ') as w from grams where size > 1 and f >= 10
), cuts as materialized (
  select lang, phrase, a, k, array_to_string(w[1:k], ' ') as front, array_to_string(w[k + 1:], ' ') as back
  from candidates, (values (1), (2)) as v(k) where k < size
), lefts as materialized (
  select c.*, g.f as l from cuts c join grams g on g.lang = c.lang and g.phrase = c.front
), scores as (
  select c.*, g.f as r, (1000000::hugeint * a * a) // (l::hugeint * g.f) as score
  from lefts c join grams g on g.lang = c.lang and g.phrase = c.back
), lowest as (
  select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
  select lang, inner_phrase, max(a) as f
  from (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as inner_phrase from candidates where size = 3)
  group by all
), kept as (
  select o.* from lowest o left join longer g on g.lang = o.lang and g.inner_phrase = o.phrase where g.f is null or 100 * g.f < 50 * o.a
), totals as (
  select lang, sum(len(w))::bigint as n from words group by lang
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept join totals using (lang) qualify rank <= 2000
"""


def _lexical_sql() -> str:
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
with docs as (
  select doc_id, {words.format(_lower("text"))} as w from documents where text is not null
), counted as (
  select doc_id, len(w) as n, w from docs where len(w) > 0
), stats as (
  select count(*)::bigint as docs, sum(n)::bigint as length from counted
), tfs as (
  select doc_id, n, term, count(*)::bigint as tf from (select doc_id, n, unnest(w) as term from counted) group by all
), dfs as (
  select term, count(*) as df from tfs group by term
), items as (
  select item_id, unnest({words.format(_lower("text"))}) as term from benchmark where text is not null
), scores as (
  select item_id, doc_id,
         sum(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)::double))::bigint
             * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::bigint as score
  from items join tfs using (term) join dfs using (term), stats group by item_id, doc_id
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scores where score > 0 qualify rank <= 20
"""


ORACLE = {
    "op1_url_filter": _url_sql(),
    "op4_license_scan": _license_sql(),
    "op12_collocations": _collocation_sql(),
    "op13_lexical_search": _lexical_sql(),
}
