"""Run names: components, parsing, the next free index, the latest run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import (
    Naming,
    join_parts,
    last_part,
    legacy_name,
    run_prefix,
    run_suffix,
    size_tag,
    slug,
)
from ..session import stored

# Indices up to here are searched first; prefixes that used them all are searched again without a limit.
FIRST_INDICES = 10_000


def with_components(requests: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Add slugs and prefixes to `base_model, dataset_name, sample_size`."""
    sep = naming.separator
    prefix = slug(F.lit(naming.run_prefix), "run", naming, allow_empty=True)
    slugs = (
        requests.withColumn("model_slug", slug(last_part(F.col("base_model"), "model"), "model", naming))
        .withColumn("dataset_slug", slug(last_part(F.col("dataset_name"), "dataset"), "dataset", naming))
        .withColumn("size_slug", slug(size_tag(F.col("sample_size")), "full", naming))
    )
    full = join_parts(sep, prefix, F.col("model_slug"), F.col("dataset_slug"), F.col("size_slug"))
    scopes = {
        "global": F.lit(""),
        "model": join_parts(sep, prefix, F.col("model_slug")),
        "model_dataset": full,
    }
    return slugs.withColumn("full_prefix", full).withColumn("scope_prefix", scopes[naming.scope])


def parse_names(names: DataFrame, naming: Naming = Naming(), name: str = "name") -> DataFrame:
    """Well-formed names only, with `prefix` and `index`."""
    return names.where(F.col(name).rlike(naming.pattern)).select(
        *names.columns,
        F.regexp_extract(name, naming.pattern, 1).alias("prefix"),
        F.regexp_extract(name, naming.pattern, 2).try_cast("long").alias("index"),
    )


def smallest_free(starts: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """`key, index`: per key the smallest number from its start on that is not used.

    It is the start itself or follows a used number, so these are the only
    candidates. Joins are on `(key, index)`: no key gathers in one task.
    """
    candidates = starts.select(key, F.col("start").alias("index")).unionByName(
        used.select(key, (F.col("index") + 1).alias("index"))
    )
    return candidates.join(used, [key, "index"], "left_anti").groupBy(key).agg(F.min("index").alias("index"))


def used_indices(scopes: DataFrame, existing: DataFrame) -> DataFrame:
    """`scope_prefix, index` over runs whose prefix starts with the scope or the other way round.

    Both directions are equi-joins on a leading part of the longer side. Only
    lengths the other side has are tried, and names are short.
    """
    runs = existing.select("prefix", "index").distinct()
    scope_lengths = scopes.agg(F.collect_set(F.length("scope_prefix"))).scalar()
    run_lengths = runs.agg(F.collect_set(F.length("prefix"))).scalar()

    def leading(rows: DataFrame, text: str, lengths: Column, name: str) -> DataFrame:
        fitting = F.array_intersect(lengths, F.sequence(F.lit(0), F.length(text)))
        return rows.withColumn("_n", F.explode(fitting)).withColumn(name, F.left(F.col(text), F.col("_n")))

    longer_runs = leading(runs, "prefix", scope_lengths, "scope_prefix").select("scope_prefix", "index").distinct()
    shorter_runs = leading(scopes, "scope_prefix", run_lengths, "prefix").join(runs, "prefix")
    return (
        longer_runs.join(scopes.select("scope_prefix"), "scope_prefix", "left_semi")
        .unionByName(shorter_runs.select("scope_prefix", "index"))
        .distinct()
    )


def next_index(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """`scope_prefix, index`: the smallest free index of every scope asked for.

    Steps are stored, since each is read several times by the next.
    """
    scopes = stored(requests.select("scope_prefix").distinct(), "scopes")
    runs = stored(existing.select("prefix", "index").distinct(), "runs")
    near = stored(_first_free(scopes, runs.where(F.col("index") <= FIRST_INDICES)), "free")
    full = near.where(F.col("index") > FIRST_INDICES).select("scope_prefix")
    if full.isEmpty():
        return near
    far = _first_free(stored(full, "full-scopes"), runs)
    return near.where(F.col("index") <= FIRST_INDICES).unionByName(far)


def _first_free(scopes: DataFrame, runs: DataFrame) -> DataFrame:
    used = stored(used_indices(scopes, runs), "used")
    return smallest_free(scopes.withColumn("start", F.lit(1).cast("long")), used, "scope_prefix")


def name_runs(requests: DataFrame, taken: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Name every request: `index`, `prefix`, `name`, and `error` where there is no valid one.

    `requests`: `request_id, base_model, dataset_name, sample_size` and optional
    `explicit_name`, `forced_index`, `use_legacy`. `taken`: `name` of everything
    below the output and log roots. A legacy request keeps its plain name, an explicit
    name must be well-formed, a forced index must be free, and an index whose
    shortened name exists already moves on to the next free one.
    """
    for column, kind in (("explicit_name", "string"), ("forced_index", "long"), ("use_legacy", "boolean")):
        if column not in requests.columns:
            requests = requests.withColumn(column, F.lit(None).cast(kind))
    taken = stored(taken.select("name").distinct(), "taken")
    existing = stored(parse_names(taken, naming), "existing")
    asked = with_components(requests, naming)
    explicit = F.trim(F.col("explicit_name"))
    legacy = F.coalesce(F.col("use_legacy"), F.lit(False))
    named = F.coalesce(explicit, F.lit("")) != ""
    mode = F.when(legacy, "legacy").when(named, "explicit").when(F.col("forced_index").isNotNull(), "forced")
    asked = stored(asked.withColumn("mode", F.coalesce(mode, F.lit("auto"))), "asked")

    given = asked.where(F.col("mode").isin("legacy", "explicit"))
    is_legacy = F.col("mode") == "legacy"
    old = legacy_name(F.col("base_model"), F.col("dataset_name"), F.col("sample_size"))
    malformed = ~is_legacy & ~explicit.rlike(naming.pattern)
    given = (
        given.withColumn("name", F.when(is_legacy, old).when(~malformed, explicit))
        .withColumn("prefix", F.when(is_legacy, old).when(~malformed, F.regexp_extract(explicit, naming.pattern, 1)))
        .withColumn(
            "index",
            F.when(is_legacy, F.lit(-1)).otherwise(F.regexp_extract(explicit, naming.pattern, 2).try_cast("long")),
        )
        .withColumn("error", F.when(malformed, "malformed_name"))
    )

    auto = asked.where(F.col("mode") == "auto")
    first = stored(auto.join(next_index(auto, existing), "scope_prefix"), "first")
    bumped = _past_collisions(first.select("full_prefix", F.col("index").alias("start")).distinct(), existing, naming)
    auto = first.withColumnRenamed("index", "start").join(bumped, ["full_prefix", "start"]).drop("start")
    auto = _with_name(auto, naming).withColumn("error", F.lit(None).cast("string"))

    forced = asked.where(F.col("mode") == "forced").withColumn("index", F.col("forced_index"))
    used = used_indices(forced.select("scope_prefix").distinct(), existing).withColumn("_used", F.lit(True))
    forced = (
        _with_name(forced.join(used, ["scope_prefix", "index"], "left"), naming)
        .join(taken.withColumn("_exists", F.lit(True)), "name", "left")
        .withColumn(
            "error",
            F.when(F.col("index") <= 0, "index_not_positive")
            .when(F.col("_used"), "index_taken")
            .when(F.col("_exists"), "name_taken"),
        )
    )
    columns = ["request_id", "mode", "index", "prefix", "name", "model_slug", "dataset_slug", "size_slug", "error"]
    return (
        auto.select(*columns).unionByName(given.select(*columns)).unionByName(forced.select(*columns))
    )


def _with_name(rows: DataFrame, naming: Naming) -> DataFrame:
    prefix = run_prefix(F.col("full_prefix"), F.col("index"), naming)
    return rows.withColumn("prefix", prefix).withColumn("name", F.concat("prefix", run_suffix(F.col("index"), naming)))


def _past_collisions(starts: DataFrame, existing: DataFrame, naming: Naming) -> DataFrame:
    """`full_prefix, start, index`: from `start`, the first index whose composed name is free."""
    keyed = starts.withColumn("_key", F.struct("full_prefix", "start"))
    digits = F.explode(F.sequence(F.length(F.col("start").cast("string")), F.lit(18))).alias("digits")
    spelled = keyed.select("_key", "full_prefix", "start", digits)
    # The prefix depends on the index only through its number of digits.
    sample = F.expr("cast(pow(10, digits - 1) as bigint)")
    spelled = spelled.withColumn("prefix", run_prefix(F.col("full_prefix"), sample, naming))
    plain = existing.where(~F.regexp_extract("name", naming.pattern, 2).rlike(r"\A0\d"))
    hits = spelled.join(
        plain.select("prefix", "index", F.length(F.col("index").cast("string")).alias("digits")), ["prefix", "digits"]
    ).where(F.col("index") >= F.col("start"))
    hits = stored(hits.select("_key", "index"), "hits")
    free = smallest_free(keyed.select("_key", "start"), hits, "_key")
    return free.select("_key.full_prefix", "_key.start", "index")


def latest_run(touches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The run touched last; of several at one time the last by name."""
    last = F.max_by("run", F.struct("touched_at", "run"))
    return touches.groupBy(*(by or [])).agg(last.alias("run"), F.max("touched_at").alias("touched_at"))
