"""Queries over the run catalog, on names and artefacts rendered from `part`, `orders` and `lineitem`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import naming as names
from ..functions.text import slash_path
from ..operators import checkpoints, runs, stages
from ..session import scratch_path
from ..sources import listing, sinks
from ..sources.tables import table

SHORT = names.Naming(max_segment_length=12, max_name_length=30)
ROOT = "/srv/outputs"


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def sample_size() -> Column:
    return F.when(F.col("p_size") % 5 != 0, F.col("p_size"))


def run_requests(spark, folder) -> DataFrame:
    """One naming request per part: brand as model, type as dataset, size as sample size."""
    key = F.col("p_partkey")
    explicit = F.when(key % 22 == 0, text("my-model-run", key)).when(key % 11 == 0, "Bad Name")
    return table(spark, folder, "part").select(
        key.alias("request_id"),
        text("hub/", F.col("p_brand")).alias("base_model"),
        text("hub/", F.col("p_type"), " ", F.col("p_name")).alias("dataset_name"),
        sample_size().alias("sample_size"),
        explicit.alias("explicit_name"),
        F.when(key % 13 == 0, F.col("p_size").cast("long") - 3).alias("forced_index"),
        (key % 17 == 0).alias("use_legacy"),
    )


def components(spark, folder, naming=names.Naming()) -> DataFrame:
    return runs.with_components(run_requests(spark, folder), naming)


def taken_names(spark, folder, naming=names.Naming()) -> DataFrame:
    """Names below the roots: runs of two thirds of the parts, shorter prefixes, and other entries."""
    key = F.col("request_id")
    index = F.when(key % 4 == 0, 2).otherwise(key % 5 + 1)
    prefix = F.when(key % 6 == 1, F.concat_ws("-", F.lit("run"), "model_slug")).otherwise(F.col("full_prefix"))
    name = F.when(key % 9 == 8, text("tmp_", key)).otherwise(names.run_name(prefix, index, naming))
    rows = components(spark, folder, naming).where(key % 3 != 2)
    return rows.select(name.alias("name")).distinct()


def slugs(spark, folder):
    raw = text(" Él-", F.col("p_name"), " #", F.col("p_type"), "! ")
    tight = names.Naming(max_segment_length=20)
    return table(spark, folder, "part").select(
        "p_partkey", names.slug(raw, "model", tight).alias("slug"), names.slug(text("é "), "dataset").alias("empty_slug")
    )


def run_parts(spark, folder):
    model, dataset = F.col("base_model"), F.col("dataset_name")
    return components(spark, folder).select(
        "request_id",
        "model_slug",
        "dataset_slug",
        "size_slug",
        "full_prefix",
        names.prepared_dir(dataset, F.col("sample_size")).alias("prepared_dir"),
        names.legacy_name(model, dataset, F.col("sample_size")).alias("legacy_name"),
    )


def parsed(spark, folder):
    return runs.parse_names(taken_names(spark, folder))


def next_indices(spark, folder):
    requests = components(spark, folder)
    return runs.next_index(requests, runs.parse_names(taken_names(spark, folder)))


def composed(spark, folder):
    return runs.name_runs(run_requests(spark, folder), taken_names(spark, folder, SHORT), SHORT)


def orders(spark, folder) -> DataFrame:
    return table(spark, folder, "orders")


def last_run(spark, folder):
    touches = orders(spark, folder).select(
        text("run-", F.col("o_custkey")).alias("run"), F.col("o_orderdate").alias("touched_at"), "o_orderpriority"
    )
    last = runs.latest_run(touches, ["o_orderpriority"])
    return last.withColumn("touched_at", F.date_format("touched_at", "yyyy-MM-dd"))


def run_of_artifact(spark, folder):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    path = (
        F.when(key % 4 == 0, text(ROOT, "/run-", cust, "/merged"))
        .when(key % 4 == 1, text(ROOT, "/run-", cust, "/a/../../run-", key, "/./adapter"))
        .when(key % 4 == 2, text("/srv/elsewhere/run-", cust))
        .otherwise(text(ROOT, "/"))
    )
    return orders(spark, folder).select("o_orderkey", names.owning_run(path, ROOT).alias("run"))


def clean_paths(spark, folder):
    key = F.col("o_orderkey")
    path = F.when(key % 2 == 0, text("\\Outputs\\run-", key, "\\.\\merged\\")).otherwise(text("//custom/../path-", key))
    resume = text("run-", key, "\\trainer_state\n", "checkpoint-1")
    return orders(spark, folder).select(
        "o_orderkey", names.artifact_path(path).alias("override_path"), slash_path(resume).alias("resume_path")
    )


def artifacts(spark, folder) -> DataFrame:
    """`dir, file`: checkpoint files of runs, one run per order; a file may be listed repeatedly."""
    number, flag = F.col("l_linenumber"), F.col("l_returnflag")
    state = text(ROOT, "/run-", F.col("l_orderkey"), "/trainer_state")
    step = F.when(number == 6, "x").otherwise((number * 10).cast("string"))
    file = F.when(flag == "A", "adapter_model.safetensors").when(flag == "N", "optimizer.pt").otherwise("trainer_state.json")
    folder_ = F.when(number == 7, state).otherwise(text(state, "/checkpoint-", step))
    return table(spark, folder, "lineitem").select(folder_.alias("dir"), file.alias("file"))


def valid(spark, folder):
    return checkpoints.valid_checkpoints(artifacts(spark, folder))


def located(spark, folder):
    return checkpoints.locate_checkpoints(artifacts(spark, folder))


def last_adapter(spark, folder):
    adapters = orders(spark, folder).select(
        text(ROOT, "/run-", F.col("o_orderkey"), "/adapter").alias("path"),
        F.col("o_orderdate").alias("mtime"),
        "o_orderpriority",
    )
    last = checkpoints.latest_adapter(adapters, ["o_orderpriority"])
    return last.withColumn("mtime", F.date_format("mtime", "yyyy-MM-dd"))


def resumed(spark, folder):
    key = F.col("o_orderkey")
    state = text(ROOT, "/run-", key, "/trainer_state")
    requested = (
        F.when(key % 7 == 1, "latest")
        .when(key % 7 == 2, "checkpoint-30")
        .when(key % 7 == 3, "trainer_state\\checkpoint-20")
        .when(key % 7 == 4, text("run-", key, "/trainer_state/checkpoint-10"))
        .when(key % 7 == 5, state)
        .when(key % 7 == 6, text(state, "/checkpoint-10/adapter_model.safetensors"))
    )
    requests = orders(spark, folder).select(
        key.alias("request_id"), requested.alias("requested"), state.alias("default_path")
    )
    return checkpoints.resolve_resume(requests, artifacts(spark, folder))


def served(spark, folder):
    key = F.col("o_orderkey")
    override = F.when(key % 5 == 0, text("\\outputs\\custom\\", key)).when(key % 5 == 1, " None ").when(key % 5 == 2, "")
    rows = orders(spark, folder).select(
        text("run-", key).alias("run"), override.alias("override"), (key % 3 != 0).alias("prefer_quantised")
    )
    there = orders(spark, folder).where(F.col("o_orderstatus") == "F").select(text("run-", key, "/merged_awq").alias("path"))
    return checkpoints.served_artifact(rows, there)


STAGES = ["export-merged", "convert-awq", "eval-sft", "serve-vllm", "preprocess-sft", "plot"]


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def guarded(spark, folder):
    key = F.col("o_orderkey")
    requests = orders(spark, folder).select(
        key.alias("request_id"), text("run-", F.col("o_custkey")).alias("run"), pick(STAGES, key % 6).alias("stage")
    )
    there = table(spark, folder, "customer").where(F.col("c_custkey") % 3 == 0)
    return stages.stage_guard(requests, there.select(text("run-", F.col("c_custkey")).alias("run")))


def chained(spark, folder):
    key = F.col("o_orderkey")
    rows = orders(spark, folder).select(
        text("run-", F.col("o_custkey")).alias("run"),
        key.alias("position"),
        pick(STAGES, key % 6).alias("stage"),
        F.when(F.col("o_orderstatus") == "P", 2).otherwise(0).alias("returncode"),
    )
    return stages.stage_chain(rows)


def attempts(spark, folder):
    rows = (
        table(spark, folder, "lineitem")
        .groupBy(text("run-", F.col("l_orderkey")).alias("run"), F.col("l_linenumber").alias("attempt"))
        .agg(F.min("l_returnflag").alias("flag"))
    )
    code = F.when((F.col("attempt") == 7) & (F.col("flag") == "A"), 0).when(F.col("flag") == "N", 3).otherwise(2)
    return stages.attempt_rollup(rows.select("run", "attempt", code.alias("returncode")), 7)


def unprepared(spark, folder):
    print_ = stages.fingerprint(F.col("o_orderpriority"), F.col("o_custkey") % 100, F.lit(None).cast("string"))
    rows = orders(spark, folder).select("o_orderkey", print_.alias("fingerprint"), "o_orderstatus")
    done = rows.where((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 20 == 0))
    return stages.not_prepared(rows.drop("o_orderstatus"), done)


def listed(spark, folder):
    return listing.list_files(spark, folder, "*.parquet").select("file", (F.col("length") > 0).alias("has_bytes"))


def run_metadata(spark, folder):
    rows = orders(spark, folder).groupBy(F.regexp_extract("o_orderpriority", "[A-Z]+", 0).alias("run")).agg(
        F.count(F.lit(1)).alias("total_tokens"), F.max("o_totalprice").alias("train_loss")
    )
    out = scratch_path(spark, "metadata")
    sinks.write_summary(rows, out, "train", ["run"])
    found = listing.read_run_metadata(spark, out, "train struct<total_tokens long, train_loss double>")
    return found.select(F.regexp_extract("file", "run=([^/]+)", 1).alias("run"), "train.*")


QUERIES = {
    "slugify": slugs,
    "run_components": run_parts,
    "parse_run_names": parsed,
    "next_run_index": next_indices,
    "compose_run_name": composed,
    "latest_run": last_run,
    "artifact_run": run_of_artifact,
    "normalize_artifact_path": clean_paths,
    "valid_checkpoints": valid,
    "latest_checkpoint": located,
    "latest_adapter": last_adapter,
    "resolve_resume": resumed,
    "served_artifact": served,
    "stage_guard": guarded,
    "stage_chain": chained,
    "attempt_rollup": attempts,
    "prepared_reuse": unprepared,
    "artifact_listing": listed,
    "run_metadata_scan": run_metadata,
}


def sql_truncate(value: str, limit: str) -> str:
    head = f"regexp_replace(({value})[:greatest(1, {limit} - 5)], '-+$', '')"
    digest = f"sha1({value})[:4]"
    return f"case when length({value}) <= {limit} then {value} else coalesce(nullif({head}, ''), {digest}) || '-' || {digest} end"


def sql_slug(value: str, fallback: str, limit: int) -> str:
    kept = rf"trim(regexp_replace({value}, '[^\x00-\x7F]', '', 'g'))"
    parted = f"regexp_replace(lower(coalesce(nullif({kept}, ''), '{fallback}')), '[^a-z0-9]+', '-', 'g')"
    full = f"coalesce(nullif(trim({parted}, '-'), ''), '{fallback}')"
    return sql_truncate(full, str(limit))


def sql_components(limit: int) -> str:
    return f"""(select *, 'run-' || model_slug || '-' || dataset_slug || '-' || size_slug as full_prefix from (
      select p_partkey as request_id, p_brand, p_type || ' ' || p_name as dataset, p_size,
        case when p_size % 5 <> 0 then p_size end as sample_size,
        {sql_slug('p_brand', 'model', limit)} as model_slug,
        {sql_slug("(p_type || ' ' || p_name)", 'dataset', limit)} as dataset_slug,
        case when p_size % 5 <> 0 then 'n' || p_size else 'full' end as size_slug from part))"""


def sql_name(prefix: str, index: str, limit: int) -> tuple[str, str]:
    cut = sql_truncate(prefix, f"({limit} - length('-run' || {index}))")
    return f"({cut})", f"(({cut}) || '-run' || {index})"


def sql_taken(segment: int, limit: int) -> str:
    name = sql_name("prefix", "idx", limit)[1]
    return f"""(select distinct case when request_id % 9 = 8 then 'tmp_' || request_id else {name} end as name from (
      select request_id, case when request_id % 4 = 0 then 2 else request_id % 5 + 1 end as idx,
        case when request_id % 6 = 1 then 'run-' || model_slug else full_prefix end as prefix
      from {sql_components(segment)} where request_id % 3 <> 2))"""


def sql_parsed(segment: int, limit: int) -> str:
    return rf"""(select name, regexp_extract(name, '^([a-z0-9-]+)-run(\d+)$', 1) as prefix,
        regexp_extract(name, '^([a-z0-9-]+)-run(\d+)$', 2)::bigint as "index"
      from {sql_taken(segment, limit)} where regexp_matches(name, '^([a-z0-9-]+)-run(\d+)$'))"""


def sql_used(segment: int, limit: int) -> str:
    return f"""(select distinct full_prefix, "index" as i from (select distinct full_prefix from {sql_components(segment)}) s
      join {sql_parsed(segment, limit)} e on starts_with(e.prefix, s.full_prefix) or starts_with(s.full_prefix, e.prefix))"""


def sql_free(segment: int, limit: int) -> str:
    return f"""(with used as {sql_used(segment, limit)},
      candidates as (select full_prefix, 1::bigint as i from {sql_components(segment)} union select full_prefix, i + 1 from used)
      select full_prefix, min(i) as i from candidates c where not exists (
        select 1 from used u where u.full_prefix = c.full_prefix and u.i = c.i) group by 1)"""


def sql_composed(segment: int, limit: int) -> str:
    """Auto indices step past existing names by trying the next 40 numbers."""
    auto_name = sql_name("full_prefix", "k", limit)
    forced = sql_name("full_prefix", "forced", limit)
    legacy = "translate(dataset, '-', '_') || '_' || size_slug || '_' || translate(p_brand, '-', '_')"
    columns = 'request_id, mode, "index", prefix, name, model_slug, dataset_slug, size_slug, error'
    return rf"""with asked as (select *, case when request_id % 13 = 0 then p_size - 3 end as forced,
        case when request_id % 22 = 0 then 'my-model-run' || request_id when request_id % 11 = 0 then 'Bad Name' end as explicit,
        case when request_id % 17 = 0 then 'legacy' when request_id % 11 = 0 then 'explicit'
          when request_id % 13 = 0 then 'forced' else 'auto' end as mode from {sql_components(segment)}),
      taken as {sql_taken(segment, limit)},
      tried as (select *, {auto_name[0]} as prefix, {auto_name[1]} as name from (
        select a.*, unnest(range(f.i, f.i + 40)) as k from asked a join {sql_free(segment, limit)} f using (full_prefix)
        where mode = 'auto')),
      auto as (select *, k as "index", null as error from tried where name not in (select name from taken)
        qualify row_number() over (partition by request_id order by k) = 1),
      given as (select * exclude (forced), case when mode = 'legacy' then -1
            when explicit <> 'Bad Name' then request_id end as "index",
          case when mode = 'legacy' then {legacy} when explicit <> 'Bad Name' then explicit end as name,
          case when mode = 'legacy' then {legacy} when explicit <> 'Bad Name' then 'my-model' end as prefix,
          case when mode = 'explicit' and explicit = 'Bad Name' then 'malformed_name' end as error
        from asked where mode in ('legacy', 'explicit')),
      forced as (select *, forced as "index", {forced[0]} as prefix, {forced[1]} as name,
          case when forced <= 0 then 'index_not_positive'
            when exists (select 1 from {sql_used(segment, limit)} u where u.full_prefix = a.full_prefix and u.i = a.forced) then 'index_taken'
            when {forced[1]} in (select name from taken) then 'name_taken' end as error
        from asked a where mode = 'forced')
      select {columns} from auto union all select {columns} from given union all select {columns} from forced"""


SQL_ARTIFACTS = f"""(select distinct case when l_linenumber = 7 then state
      else state || '/checkpoint-' || case when l_linenumber = 6 then 'x' else (l_linenumber * 10)::varchar end end as dir,
    case l_returnflag when 'A' then 'adapter_model.safetensors' when 'N' then 'optimizer.pt' else 'trainer_state.json' end as file
  from (select *, '{ROOT}/run-' || l_orderkey || '/trainer_state' as state from lineitem))"""
SQL_LOCATED = rf"""(with dirs as (select dir, bool_or(file = 'adapter_model.safetensors') as ok,
      bool_or(file = 'trainer_state.json') as has_state from {SQL_ARTIFACTS} group by 1),
    options as (select dir as target, 0 as choice, 0 as step, dir from dirs where ok
      union all select regexp_replace(dir, '/[^/]*$', ''), 1, coalesce(try_cast(regexp_extract(dir, '([^-]*)$', 1) as bigint), -1), dir
        from dirs where ok and dir like '%/checkpoint-%'
      union all select dir, 2, 0, dir from dirs where has_state)
    select target, dir as checkpoint from options
    qualify row_number() over (partition by target order by choice, step desc, dir desc) = 1)"""
SQL_STAGE = "[" + ", ".join(f"'{s}'" for s in STAGES) + "][o_orderkey % 6 + 1]"
SQL_POST = "('export-merged', 'convert-awq', 'eval-sft', 'serve-vllm')"
SQL_CHAIN = f"""select 'run-' || o_custkey as run, o_orderkey as position, {SQL_STAGE} as stage,
  case when o_orderstatus = 'P' then 2 else 0 end as returncode from orders"""

ORACLE = {
    "slugify": f"""select p_partkey, {sql_slug("(' Él-' || p_name || ' #' || p_type || '! ')", 'model', 20)} as slug,
      'dataset' as empty_slug from part""",
    "run_components": f"""select request_id, model_slug, dataset_slug, size_slug, full_prefix,
        translate(dataset || '_' || coalesce(sample_size::varchar, 'full'), '-', '_') as prepared_dir,
        translate(dataset, '-', '_') || '_' || size_slug || '_' || translate(p_brand, '-', '_') as legacy_name
      from {sql_components(64)}""",
    "parse_run_names": f"select * from {sql_parsed(64, 128)}",
    "next_run_index": f'select full_prefix as scope_prefix, i as "index" from {sql_free(64, 128)}',
    "compose_run_name": sql_composed(12, 30),
    "latest_run": """select o_orderpriority, max_by('run-' || o_custkey, (o_orderdate, 'run-' || o_custkey)) as run,
      strftime(max(o_orderdate), '%Y-%m-%d') as touched_at from orders group by 1""",
    "artifact_run": """select o_orderkey, case o_orderkey % 4 when 0 then 'run-' || o_custkey
      when 1 then 'run-' || o_orderkey end as run from orders""",
    "normalize_artifact_path": """select o_orderkey, case when o_orderkey % 2 = 0 then 'run-' || o_orderkey || '/merged'
      else 'custom/path-' || o_orderkey end as override_path,
      'run-' || o_orderkey || '/trainer_state/checkpoint-1' as resume_path from orders""",
    "valid_checkpoints": f"select distinct dir from {SQL_ARTIFACTS} where file = 'adapter_model.safetensors'",
    "latest_checkpoint": f"select * from {SQL_LOCATED}",
    "latest_adapter": f"""select o_orderpriority,
        max_by(path, (o_orderdate, path)) as path, strftime(max(o_orderdate), '%Y-%m-%d') as mtime
      from (select *, '{ROOT}/run-' || o_orderkey || '/adapter' as path from orders) group by 1""",
    "resolve_resume": f"""with asked as (select *, case request_id % 7 when 1 then state when 2 then state || '/checkpoint-30'
          when 3 then state || '/checkpoint-20' when 4 then '{ROOT}/run-' || request_id || '/trainer_state/checkpoint-10'
          when 5 then state when 6 then state || '/checkpoint-10/adapter_model.safetensors' end as target,
        case request_id % 7 when 1 then 'latest' when 2 then 'checkpoint-30' when 3 then 'trainer_state\\checkpoint-20'
          when 4 then 'run-' || request_id || '/trainer_state/checkpoint-10' when 5 then state
          when 6 then state || '/checkpoint-10/adapter_model.safetensors' end as requested
        from (select o_orderkey as request_id, '{ROOT}/run-' || o_orderkey || '/trainer_state' as state from orders)),
      found as (select target, checkpoint from {SQL_LOCATED} union all
        select distinct dir || '/' || file, dir || '/' || file from {SQL_ARTIFACTS})
      select request_id, requested, checkpoint, case when target is null then 'not_requested'
        when checkpoint is null then 'not_found' else 'resolved' end as status
      from asked left join found using (target)""",
    "served_artifact": """select 'run-' || o_orderkey as run, case source when 'override' then 'custom/' || o_orderkey
        when 'awq' then 'run-' || o_orderkey || '/merged_awq' else 'run-' || o_orderkey || '/merged' end as served_path, source
      from (select o_orderkey, case when o_orderkey % 5 = 0 then 'override'
        when o_orderkey % 3 <> 0 and o_orderstatus = 'F' then 'awq' else 'merged' end as source from orders)""",
    "stage_guard": f"""select o_orderkey as request_id, 'run-' || o_custkey as run, {SQL_STAGE} as stage,
        case when {SQL_STAGE} in {SQL_POST} and not exists (
          select 1 from customer where c_custkey = o_custkey and c_custkey % 3 = 0) then 'blocked' else 'allowed' end as status
      from orders""",
    "stage_chain": f"""select *, case when position > stop then 'not_run' when position = stop then 'failed'
        when stage not in {SQL_POST} then 'unknown_stage' else 'ok' end as status
      from (select *, min(position) filter (returncode <> 0 and stage in {SQL_POST}) over (partition by run) as stop
        from ({SQL_CHAIN}))""".replace("select *, case", "select * exclude (stop), case"),
    "attempt_rollup": """select 'run-' || l_orderkey as run, count(*) as n_attempts,
        min(l_linenumber) filter (rc = 0) as first_success,
        case when count(*) filter (rc = 0) > 0 then 0 else max_by(rc, l_linenumber) end as returncode,
        case case when count(*) filter (rc = 0) > 0 then 0 else max_by(rc, l_linenumber) end when 0 then 'success'
          when 2 then 'compression exception' when 3 then 'missing merged path' end as meaning,
        coalesce(sum(l_linenumber * 5) filter (rc <> 0 and l_linenumber < 7), 0)::bigint as wait_seconds
      from (select l_orderkey, l_linenumber, case when l_linenumber = 7 and min(l_returnflag) = 'A' then 0
          when min(l_returnflag) = 'N' then 3 else 2 end as rc from lineitem group by 1, 2) group by l_orderkey""",
    "prepared_reuse": """with rows as (select *, sha256(o_orderpriority || '|' || (o_custkey % 100) || '|null') as fingerprint from orders)
      select o_orderkey, fingerprint from rows where fingerprint not in (
        select fingerprint from rows where o_orderstatus = 'F' and o_orderkey % 20 = 0)""",
    "artifact_listing": """select name || '.parquet' as file, true as has_bytes from (values ('region'), ('nation'), ('customer'),
      ('supplier'), ('part'), ('orders'), ('lineitem'), ('events'), ('documents'), ('embeddings'), ('pages'), ('benchmark'),
      ('labels'), ('conversations')) tables(name)""",
    "run_metadata_scan": """select regexp_extract(o_orderpriority, '[A-Z]+', 0) as run, count(*) as total_tokens,
      max(o_totalprice) as train_loss from orders group by 1""",
}
