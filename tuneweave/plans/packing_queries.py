"""Queries over packing and batch layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import packing
from ..params import TrainLayout
from .corpus_queries import SEED, documents, sql_count

BLOCK = 512
END = "<eos>"
LAYOUT = TrainLayout(batch_size=4, gradient_accumulation=8, epochs=3, max_steps=None, logging_steps=10, eval_steps=5)
CAPPED = TrainLayout(batch_size=2, gradient_accumulation=4, epochs=2, max_steps=40, logging_steps=10, eval_steps=5)


def membership(spark, folder):
    return packing.pack_membership(documents(spark, folder), BLOCK, "doc_id", SEED)


def blocks(spark, folder):
    packed = packing.pack_blocks(documents(spark, folder), BLOCK, "doc_id", SEED, eos=END)
    return packed.select("chunk_id", "n_docs", "n_tokens", F.md5(F.array_join("tokens", " ")).alias("text_md5"))


def stats(spark, folder):
    found = packing.pack_stats(documents(spark, folder), BLOCK, "doc_id", seed=SEED)
    return found.withColumn("fill", F.round("fill", 6)).withColumn("docs_per_block", F.round("docs_per_block", 6))


def plan(spark, folder):
    return packing.step_plan(documents(spark, folder), "doc_id", LAYOUT, SEED)


def capped_plan(spark, folder):
    return packing.step_plan(documents(spark, folder), "doc_id", CAPPED, SEED)


QUERIES = {
    "pack_membership": membership,
    "pack_blocks": blocks,
    "pack_stats": stats,
    "step_plan": plan,
    "step_plan_capped": capped_plan,
}

SQL_PLACED = f"""select doc_id, text, n, (sum(n) over (order by h, doc_id) - n)::bigint as s,
    (sum(n) over ())::bigint as total
  from (select doc_id, text, {sql_count('text')} + 1 as n, md5('{SEED}:pack:' || doc_id) as h from documents)"""
SQL_MEMBERS = f"""select chunk_id, doc_id, greatest(s, chunk_id * {BLOCK}) - s as from_token,
    least(s + n, (chunk_id + 1) * {BLOCK}) - s as to_token
  from (select *, unnest(range(s // {BLOCK}, (s + n - 1) // {BLOCK} + 1)) as chunk_id from ({SQL_PLACED}))
  where chunk_id < total // {BLOCK}"""


def sql_plan(layout: TrainLayout) -> str:
    per_step = layout.rows_per_step
    cap = f"where step <= {layout.max_steps}" if layout.max_steps else ""
    return f"""select epoch, step, micro_batch, slot, doc_id, step % {layout.logging_steps} = 0 as log_mark,
        step % {layout.eval_steps} = 0 as eval_mark, step % {layout.eval_steps} = 0 as save_mark
      from (select *, epoch * ((n + {per_step - 1}) // {per_step}) + r // {per_step} + 1 as step,
          (r % {per_step}) // {layout.batch_size} as micro_batch, r % {layout.batch_size} as slot
        from (select doc_id, epoch, count(*) over (partition by epoch) as n,
            row_number() over (partition by epoch order by md5('{SEED}:step:' || epoch || ':' || doc_id), doc_id) - 1 as r
          from documents, range({layout.epochs}) epochs(epoch))) {cap}"""


ORACLE = {
    "pack_membership": SQL_MEMBERS,
    "pack_blocks": rf"""select chunk_id, count(distinct doc_id) as n_docs, count(*) as n_tokens,
        md5(string_agg(token, ' ' order by p)) as text_md5
      from (select doc_id, token, p, p // {BLOCK} as chunk_id, total from (
        select doc_id, total, unnest(list_append(regexp_extract_all(text, '\S+'), '{END}')) as token,
          unnest(range(s, s + n)) as p from ({SQL_PLACED})))
      where chunk_id < total // {BLOCK} group by 1""",
    "pack_stats": f"""select *, round(n_blocks * {BLOCK} / n_tokens::double, 6) as fill,
        round((select count(*) from ({SQL_MEMBERS})) / n_blocks::double, 6) as docs_per_block
      from (select count(*) as n_docs, sum(n)::bigint as n_tokens, (sum(n) // {BLOCK})::bigint as n_blocks,
        (sum(n) % {BLOCK})::bigint as dropped_tokens from ({SQL_PLACED}))""",
    "step_plan": sql_plan(LAYOUT),
    "step_plan_capped": sql_plan(CAPPED),
}
