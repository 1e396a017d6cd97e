"""Queries over corpora: reading, filtering, templates, sampling, splits, round trips."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import instruction_messages, prompt_messages, render_messages, select_template
from ..functions.templates import render_by_template
from ..functions.text import cutoff, is_blank, token_count
from ..operators import conversations as chat
from ..operators import sampling
from ..operators.growing import GrowingSample
from ..params import PrepareParams
from ..session import scratch_path
from ..sources import calibration, jsonl, onefile, sinks
from ..sources.tables import filter_language, read_instructions, spread, table
from ..streaming import jobs
from .prepare import observed_summary, prepare_and_count, prepare_chat, prepare_instructions, prepare_rows, preprocess_summary

SEED = 215
TEST_SIZE = 0.2
CUTOFF = 64
SAMPLE = 300
EOS = "<|endoftext|>"
LANGUAGES = ["en", "fr"]
PARAMS = PrepareParams(
    sample_size=SAMPLE, languages=LANGUAGES, test_size=TEST_SIZE, cutoff_len=CUTOFF, seed=SEED, eos=EOS
)
# Conversations have no language; all of them are prepared.
CHAT_PARAMS = replace(PARAMS, languages=None, sample_size=None)

MAPPING = {
    "id": "doc_id",
    "instruction": "concat('Write in the style of ', source)",
    "input": "case when doc_id % 2 = 0 then '' else lang end",
    "output": "text",
    "lang": "lang",
}


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return read_instructions(documents(spark, folder), MAPPING)


def language_filter(spark, folder):
    return filter_language(documents(spark, folder), LANGUAGES).select("doc_id", "lang", "n_chars")


def planted_blanks(spark, folder):
    kind = F.col("doc_id") % 10
    text = F.when(kind == 0, "").when(kind == 1, " \t \n").when(kind == 2, F.lit(None)).otherwise(F.col("text"))
    return documents(spark, folder).select("doc_id", text.alias("text"))


def drop_blank(spark, folder):
    return planted_blanks(spark, folder).where(~is_blank(F.col("text")))


def count_tokens(spark, folder):
    return documents(spark, folder).select("doc_id", token_count(F.col("text")).alias("n_tokens"))


def cut_tokens(spark, folder):
    counted = documents(spark, folder).withColumn("n", token_count(F.col("text")))
    return counted.select(
        "doc_id",
        cutoff(F.col("text"), CUTOFF, F.col("n")).alias("text"),
        F.least("n", F.lit(CUTOFF)).alias("n_tokens"),
        (F.col("n") > CUTOFF).alias("was_cut"),
    )


def sample(spark, folder):
    return sampling.sample_n(documents(spark, folder).select("doc_id", "lang"), SAMPLE, "doc_id", SEED)


def split_by_hash(spark, folder):
    return sampling.split_hash(documents(spark, folder).select("doc_id"), TEST_SIZE, "doc_id", SEED)


def split_by_rank(spark, folder):
    return sampling.split_exact(documents(spark, folder).select("doc_id"), TEST_SIZE, "doc_id", SEED)


def count_splits(spark, folder):
    return sampling.split_counts(split_by_hash(spark, folder))


def summary(spark, folder):
    corpus_ = corpus(spark, folder)
    return preprocess_summary(corpus_, PARAMS).withColumn("kept_languages", F.array_join("kept_languages", ","))


def conversations(spark, folder):
    rows = chat.assemble_conversations(turns(spark, folder))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return rows.select(
        "conv_id", F.size("messages").cast("long").alias("n_turns"), F.array_join(lines, "\n").alias("transcript")
    )


def render_qwen(spark, folder):
    return chat.render_conversations(turns(spark, folder), "qwen", EOS)


def render_fallback(spark, folder):
    return chat.render_conversations(turns(spark, folder), "fallback", "", "<s>")


def template_choice(spark, folder):
    third = F.col("conv_id") % 3
    model = F.when(third == 0, "hub/Qwen2.5-0.5B").otherwise("hub/other-2b")
    own = F.when(F.col("conv_id") % 5 == 0, "qwen")
    default = F.when(F.col("conv_id") % 7 == 0, "fallback")
    chosen = turns(spark, folder).withColumn("template", select_template(own, default, model))
    rendered = chat.render_conversations(chosen, F.col("template"), EOS)
    return rendered.withColumn("template", select_template(own, default, model))


# Three templates as tokenizers carry them in their own settings.
OWN_TEMPLATES = [
    "{{ bos_token }}{% for message in messages %}{{ '<|im_start|>' + message['role'] + '\n' + message['content'] | trim + '<|im_end|>' + '\n' }}{% endfor %}",
    """{%- if messages[0].role == 'system' -%}
    {%- set system = messages[0]['content'] | trim -%}
    {%- set messages = messages[1:] -%}
{%- else -%}
    {%- set system = '' -%}
{%- endif -%}
{%- for message in messages -%}
    {%- if message.role == 'user' -%}
        {{- '[INST] ' }}{% if loop.first and system %}{{ '<<SYS>>' ~ system ~ '<</SYS>> ' }}{% endif %}{{ message.content.strip() ~ ' [/INST]' }}
    {%- elif message.role == 'assistant' -%}
        {{- ' ' ~ message.content | trim ~ ' ' ~ eos_token }}
    {%- endif -%}
{%- endfor -%}""",
    """{% for message in messages if message['role'] != 'system' %}
{{ loop.index }}. {{ message['role'].capitalize() if message['role'] in ['user', 'assistant'] else 'Other' }}: {{ message['content'] | lower }}
{% if not loop.last %}
---
{% endif %}
{% endfor %}
{% if add_generation_prompt %}
Assistant:
{% endif %}
""",
]


def own_templates(spark, folder):
    """Each conversation under the template text that its row carries."""
    texts = F.array(*[F.lit(t) for t in OWN_TEMPLATES])
    rows = chat.assemble_conversations(turns(spark, folder)).withColumn("template", F.get(texts, (F.col("conv_id") % 3).cast("int")))
    shown = render_by_template(rows, "template", "messages", bos_token="<s>", eos_token="</s>", add_generation_prompt=True)
    return shown.select("conv_id", "text")


def pair_messages(spark, folder):
    pairs = chat.turn_pairs(turns(spark, folder))
    extra = F.when(F.col("conv_id") % 2 == 0, "").otherwise(F.concat(F.lit("conversation "), F.col("conv_id").cast("string")))
    messages = instruction_messages(F.col("instruction"), extra, F.col("output"))
    return pairs.select("conv_id", "turn", render_messages("qwen", messages, EOS).alias("text"))


def prompts(spark, folder):
    messages = prompt_messages(F.col("text"))
    return table(spark, folder, "benchmark").select(
        "item_id",
        messages[0]["content"].alias("system_content"),
        messages[1]["content"].alias("user_content"),
        render_messages("fallback", messages, "", "<s>").alias("prompt_text"),
    )


def prepared_instructions(spark, folder):
    return prepare_instructions(corpus(spark, folder), PARAMS)


def prepared_chat(spark, folder):
    return prepare_chat(turns(spark, folder), CHAT_PARAMS)


def written_splits(spark, folder):
    out = scratch_path(spark, "splits")
    sinks.write_splits(prepare_instructions(corpus(spark, folder), PARAMS), out)
    return spark.read.schema("text string, split string").json(out)


def written_summary(spark, folder):
    out = scratch_path(spark, "summary")
    sinks.write_summary(preprocess_summary(corpus(spark, folder), PARAMS), out, "preprocess")
    schema = "preprocess struct<discarded long, kept_languages array<string>, sample_size long, seed long>"
    rows = spark.read.schema(schema).json(out).select("preprocess.*")
    return rows.withColumn("kept_languages", F.array_join("kept_languages", ","))


def summary_file(spark, folder):
    """The corpus is prepared and written, and the figures of that pass become one `metadata.json`."""
    out, path = scratch_path(spark, "prepared"), scratch_path(spark, "run") + "/metadata.json"
    rows, figures = prepare_and_count(corpus(spark, folder), PARAMS)
    sinks.write_splits(rows, out)
    found = observed_summary(spark, figures, PARAMS)
    onefile.write_one(found.select(F.struct(*found.columns).alias("preprocess")), path)
    schema = "preprocess struct<discarded long, kept_languages array<string>, sample_size long, seed long>"
    kept = spark.read.schema(schema).option("multiLine", True).json(path).select("preprocess.*")
    return kept.withColumn("kept_languages", F.array_join("kept_languages", ","))


def json_lines(spark, folder, good_only: bool) -> DataFrame:
    """Documents as JSON lines; unless `good_only`, with faults planted by `doc_id`."""
    docs = documents(spark, folder).select(
        "doc_id", F.to_json(F.struct("text")).alias("good"), sampling.split_label(F.col("doc_id"), TEST_SIZE, SEED).alias("split")
    )
    kind = F.col("doc_id") % 12
    faults = {0: "   ", 6: '{"text":""}'}
    if not good_only:
        faults |= {1: '{"text": "cut off', 2: '{"text":1}', 3: '{"text":null}', 4: '{"x":1}', 5: '["l"]'}
    line = F.col("good")
    for n, text in faults.items():
        line = F.when(kind == n, text).otherwise(line)
    return docs.select("doc_id", "split", line.alias("value"))


def strict_load(spark, folder):
    out = scratch_path(spark, "strict")
    json_lines(spark, folder, True).select("value", "split").write.partitionBy("split").text(out)
    rows = jsonl.load_strict(spark, out, jsonl.REQUIRED_SPLITS)
    return rows.select(F.regexp_extract("file", "split=([^/]+)", 1).alias("split"), "text")


def located_rejects(spark, folder):
    """Bad records of files of 1,000 documents each, by file and line."""
    out = scratch_path(spark, "faulty")
    rows = json_lines(spark, folder, False).withColumn("part", F.expr("doc_id div 1000"))
    rows = rows.repartition("part").sortWithinPartitions("part", "doc_id")
    rows.select("value", "part").write.partitionBy("part").text(out)
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part")
    return jsonl.load_rejects(spark, out).select(part, "line_no", "value", "reason")


def rejects(spark, folder):
    return jsonl.rejected_records(jsonl.check_records(json_lines(spark, folder, False))).select("doc_id", "reason")


def validation_texts(spark, folder):
    out = scratch_path(spark, "validation")
    lines = json_lines(spark, folder, True).where(F.col("split") == "validation")
    lines.select("value").write.text(out)
    return jsonl.load_validation(spark, out)


def absent_splits(spark, folder):
    split = F.when(F.col("source") == "web", "train").otherwise("test")
    return jsonl.missing_splits(documents(spark, folder).select(split.alias("split")))


def calibration_rows(spark, folder):
    docs = documents(spark, folder).select("text")
    parts = []
    for suffix in (".json", ".csv", ".txt"):
        out = scratch_path(spark, "calibration")
        if suffix == ".json":
            docs.write.json(out)
        elif suffix == ".csv":
            docs.write.csv(out, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        else:
            docs.select("text").write.text(out)
        rows = calibration.load_calibration(spark, out, suffix)
        parts.append(rows.select(F.lit(suffix).alias("format"), "text"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def calibration_sample(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return sampling.calibration_sample(docs, 128, 50, "doc_id", SEED)


def calibration_report(spark, folder):
    return sampling.calibration_report(documents(spark, folder), 128)


def stream_prepare(spark, folder):
    """The table is one file or a folder of files; a pattern lists both, a plain path must be a folder for a stream."""
    schema = table(spark, folder, "documents").schema
    out, state = scratch_path(spark, "prepared"), scratch_path(spark, "prepared-state")
    stream = jobs.follow_parquet(spark, f"{folder}/documents.parque[t]", "*", schema)
    jobs.append(stream, out, state, lambda s: prepare_rows(read_instructions(s, MAPPING), PARAMS)).awaitTermination()
    return spark.read.parquet(out)


def growing_sample(spark, folder):
    """The corpus in three landings; each makes a version of the sample, and the last is split exactly."""
    landing, state = scratch_path(spark, "corpus"), scratch_path(spark, "growing-state")
    rows = documents(spark, folder).select("doc_id", "lang", "text")
    kept = GrowingSample(spark, scratch_path(spark, "growing"), SAMPLE, "doc_id", SEED)
    for i in range(3):
        rows.where(F.col("doc_id") % 3 == i).write.mode("append").parquet(landing)
        stream = jobs.follow_parquet(spark, landing, "*.parquet", rows.schema)
        jobs.grow_sample(stream, kept, state).awaitTermination()
    found = kept.rows().join(kept.splits(TEST_SIZE), "doc_id")
    return found.select("doc_id", "lang", F.md5("text").alias("text_md5"), "split")


QUERIES = {
    "read_instructions": corpus,
    "filter_language": language_filter,
    "drop_blank": drop_blank,
    "token_count": count_tokens,
    "cutoff_tokens": cut_tokens,
    "sample_n": sample,
    "split_hash": split_by_hash,
    "split_exact": split_by_rank,
    "growing_sample": growing_sample,
    "split_counts": count_splits,
    "preprocess_summary": summary,
    "assemble_conversations": conversations,
    "render_qwen": render_qwen,
    "render_fallback": render_fallback,
    "select_template": template_choice,
    "own_templates": own_templates,
    "instruction_messages": pair_messages,
    "prompt_messages": prompts,
    "prepared_instructions": prepared_instructions,
    "prepared_chat": prepared_chat,
    "write_splits": written_splits,
    "write_summary": written_summary,
    "write_summary_file": summary_file,
    "load_jsonl_strict": strict_load,
    "reject_records": rejects,
    "load_rejects": located_rejects,
    "load_validation": validation_texts,
    "missing_splits": absent_splits,
    "load_calibration": calibration_rows,
    "calibration_sample": calibration_sample,
    "calibration_report": calibration_report,
    "stream_prepare": stream_prepare,
}


def sql_split(key: str) -> str:
    return (
        f"case when ('0x' || substr(md5('{SEED}:split:' || {key}), 1, 8))::bigint / 4294967296.0::double < {TEST_SIZE}::double "
        "then 'validation' else 'train' end"
    )


def sql_trim(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def sql_count(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '\S+'))"


def sql_cut(text: str, limit: int) -> str:
    head = rf"array_to_string(list_slice(regexp_extract_all({text}, '\s*\S+'), 1, {limit}), '')"
    return f"case when {sql_count(text)} > {limit} then {head} else {text} end"


def sql_qwen(role: str, content: str, position: str, eos: str = EOS) -> str:
    block = f"'<|im_start|>' || {role} || chr(10) || {sql_trim(content)} || '<|im_end|>'"
    return (
        f"case when {role} = 'system' and {position} = 0 and {content} = '' then '' "
        f"when {role} in ('user', 'system') then {block} || chr(10) "
        f"when {role} = 'assistant' then {block} || '{eos}' else '' end"
    )


def sql_fallback(role: str, content: str, position: str, eos: str, bos: str) -> str:
    gap = f"'{eos}'" if eos else "chr(10)"
    return (
        f"case when {position} = 0 then '{bos}' else {gap} end || upper({role}[1]) || lower({role}[2:]) "
        f"|| ': ' || {sql_trim(content)}"
    )


SQL_CORPUS = """select doc_id as id, 'Write in the style of ' || source as instruction,
  case when doc_id % 2 = 0 then '' else lang end as input, text as output, lang from documents"""

SQL_INSTRUCTION_TEXT = (
    "'<|im_start|>user' || chr(10) || "
    + sql_trim("concat_ws(chr(10) || chr(10), instruction, nullif(input, ''))")
    + " || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || "
    + sql_trim("output")
    + f" || '<|im_end|>{EOS}'"
)


def sql_finish(texts: str, key: str) -> str:
    return f"""select {key}, {sql_cut('text', CUTOFF)} as text, least({sql_count('text')}, {CUTOFF}) as n_tokens,
      {sql_count('text')} > {CUTOFF} as was_cut, {sql_split(key)} as split from ({texts})"""


SQL_KEPT = f"select * from ({SQL_CORPUS}) where lang in ('en', 'fr')"
SQL_SAMPLED = f"select * from ({SQL_KEPT}) order by md5('{SEED}:sample:' || id), id limit {SAMPLE}"
SQL_PREPARED = sql_finish(f"select id, {SQL_INSTRUCTION_TEXT} as text from ({SQL_SAMPLED})", "id")
SQL_CHAT = sql_finish(
    f"select conv_id, string_agg({sql_qwen('role', 'text', 'turn')}, '' order by turn) as text from conversations group by 1",
    "conv_id",
)
SQL_PAIRS = """select u.conv_id, u.turn, u.text as instruction, a.text as output from conversations u
  join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 where u.role = 'user' and a.role = 'assistant'"""
SQL_SUMMARY = f"""select least(count(*) filter (lang in ('en', 'fr')), {SAMPLE}) as sample_size,
  array_to_string(list_sort(list(distinct lang) filter (lang in ('en', 'fr'))), ',') as kept_languages,
  count(*) filter (lang not in ('en', 'fr')) as discarded, {SEED}::bigint as seed from documents"""
SQL_TEMPLATE = """case when conv_id % 5 = 0 then 'qwen' when conv_id % 7 = 0 then 'fallback'
  when conv_id % 3 = 0 then 'qwen' else 'fallback' end"""

ORACLE = {
    "read_instructions": SQL_CORPUS,
    "filter_language": "select doc_id, lang, n_chars from documents where lang in ('en', 'fr')",
    "drop_blank": "select doc_id, text from documents where doc_id % 10 not in (0, 1, 2)",
    "token_count": f"select doc_id, {sql_count('text')} as n_tokens from documents",
    "cutoff_tokens": f"""select doc_id, {sql_cut('text', CUTOFF)} as text, least({sql_count('text')}, {CUTOFF}) as n_tokens,
      {sql_count('text')} > {CUTOFF} as was_cut from documents""",
    "sample_n": f"select doc_id, lang from documents order by md5('{SEED}:sample:' || doc_id), doc_id limit {SAMPLE}",
    "split_hash": f"select doc_id, {sql_split('doc_id')} as split from documents",
    "growing_sample": f"""select doc_id, lang, md5(text) as text_md5,
        case when row_number() over (order by md5('{SEED}:split:' || doc_id), doc_id) <= ceil(count(*) over () * {TEST_SIZE})
          then 'validation' else 'train' end as split
      from (select * from documents order by md5('{SEED}:sample:' || doc_id), doc_id limit {SAMPLE})""",
    "split_exact": f"""select doc_id, case when row_number() over (order by md5('{SEED}:split:' || doc_id), doc_id)
      <= ceil(count(*) over () * {TEST_SIZE}::double) then 'validation' else 'train' end as split from documents""",
    "split_counts": f"select {sql_split('doc_id')} as split, count(*) as n_rows from documents group by 1",
    "preprocess_summary": SQL_SUMMARY,
    "assemble_conversations": """select conv_id, count(*) as n_turns,
      string_agg(role || ': ' || text, chr(10) order by turn) as transcript from conversations group by 1""",
    "render_qwen": f"""select conv_id,
      string_agg({sql_qwen('role', 'text', 'turn')}, '' order by turn) as text from conversations group by 1""",
    "render_fallback": f"""select conv_id,
      string_agg({sql_fallback('role', 'text', 'turn', '', '<s>')}, '' order by turn) as text from conversations group by 1""",
    "own_templates": r"""
with turns as (
  select conv_id, turn, role, text, regexp_replace(text, '^\s+|\s+$', '', 'g') as trimmed,
         row_number() over (partition by conv_id order by turn) - 1 as place from conversations
), shown as (
  select conv_id, 0 as kind, turn, '<|im_start|>' || role || chr(10) || trimmed || '<|im_end|>' || chr(10) as part from turns where conv_id % 3 = 0
  union all
  select conv_id, 1, t.turn, case t.role
      when 'user' then '[INST] ' || case when t.place = (case when s.conv_id is null then 0 else 1 end) and s.trimmed <> '' then '<<SYS>>' || s.trimmed || '<</SYS>> ' else '' end
        || t.trimmed || ' [/INST]'
      when 'assistant' then ' ' || t.trimmed || ' </s>' else '' end
  from turns t left join (select conv_id, trimmed from turns where place = 0 and role = 'system') s using (conv_id) where conv_id % 3 = 1
  union all
  select conv_id, 2, turn, row_number() over w || '. ' || case when role in ('user', 'assistant') then upper(role[1]) || role[2:] else 'Other' end
      || ': ' || lower(text) || chr(10) || case when row_number() over w = count(*) over (partition by conv_id) then '' else '---' || chr(10) end
  from turns where conv_id % 3 = 2 and role <> 'system' window w as (partition by conv_id order by turn)
)
select conv_id, case conv_id % 3 when 0 then '<s>' else '' end || coalesce(string_agg(part, '' order by turn), '')
    || case conv_id % 3 when 2 then 'Assistant:' || chr(10) else '' end as text
from (select distinct conv_id from conversations) left join shown using (conv_id) group by conv_id""",
    "select_template": f"""select conv_id, {SQL_TEMPLATE} as template,
      string_agg(case when {SQL_TEMPLATE} = 'qwen' then {sql_qwen('role', 'text', 'turn')}
        else {sql_fallback('role', 'text', 'turn', EOS, '')} end, '' order by turn) as text
      from conversations group by 1, 2""",
    "instruction_messages": f"""select conv_id, turn, {SQL_INSTRUCTION_TEXT} as text from (
      select *, case when conv_id % 2 = 0 then '' else 'conversation ' || conv_id end as input from ({SQL_PAIRS}))""",
    "prompt_messages": f"""select item_id, 'You are a helpful assistant.' as system_content, text as user_content,
      '<s>System: You are a helpful assistant.' || chr(10) || 'User: ' || {sql_trim('text')} as prompt_text from benchmark""",
    "prepared_instructions": SQL_PREPARED,
    "prepared_chat": SQL_CHAT,
    "write_splits": f"select text, split from ({SQL_PREPARED})",
    "write_summary": SQL_SUMMARY,
    "write_summary_file": SQL_SUMMARY,
    "load_jsonl_strict": f"""select {sql_split('doc_id')} as split, case when doc_id % 12 = 6 then '' else text end as text
      from documents where doc_id % 12 <> 0""",
    "reject_records": """select doc_id, case when doc_id % 12 = 1 then 'invalid_json' else 'missing_text' end as reason
      from documents where doc_id % 12 in (1, 2, 3, 4, 5)""",
    "load_rejects": """select part, line_no, case doc_id % 12 when 1 then '{"text": "cut off' when 2 then '{"text":1}'
          when 3 then '{"text":null}' when 4 then '{"x":1}' else '["l"]' end as value,
        case when doc_id % 12 = 1 then 'invalid_json' else 'missing_text' end as reason
      from (select doc_id, doc_id // 1000 as part, row_number() over (partition by doc_id // 1000 order by doc_id) as line_no from documents)
      where doc_id % 12 in (1, 2, 3, 4, 5)""",
    "load_validation": f"""select text from documents
      where {sql_split('doc_id')} = 'validation' and doc_id % 12 not in (0, 6)""",
    "missing_splits": """select split from (values ('train'), ('validation')) required(split)
      where split not in (select case when source = 'web' then 'train' else 'test' end from documents)""",
    "load_calibration": rf"""select '.json' as format, text from documents union all select '.csv', text from documents
      union all select '.txt', {sql_trim('line')} from (select unnest(string_split(text, chr(10))) as line from documents)
      where regexp_matches(line, '\S')""",
    "calibration_sample": f"""select doc_id, {sql_cut('text', 50)} as text, least({sql_count('text')}, 50) as n_tokens
      from (select * from documents order by md5('{SEED}:sample:' || doc_id), doc_id limit 128)""",
    "calibration_report": """select 128::bigint as requested, count(*) as available, least(count(*), 128) as used
      from documents""",
    "stream_prepare": sql_finish(f"select id, {SQL_INSTRUCTION_TEXT} as text from ({SQL_KEPT})", "id"),
}
