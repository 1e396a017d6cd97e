"""Slugs, run names and artefact paths as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import slash_path, strip

RUN_WORD = "run"


@dataclass(frozen=True)
class Naming:
    """How run names are built."""

    separator: str = "-"
    scope: str = "model_dataset"
    run_prefix: str = ""
    max_segment_length: int = 64
    max_name_length: int = 128

    def __post_init__(self) -> None:
        if len(self.separator) != 1:
            raise ValueError("separator must be one character")
        if self.scope not in ("global", "model", "model_dataset"):
            raise ValueError(f"unknown scope {self.scope!r}")
        if not 0 < self.max_segment_length <= self.max_name_length:
            raise ValueError("lengths must be positive and a segment no longer than a name")

    @property
    def pattern(self) -> str:
        sep = re.escape(self.separator)
        return rf"\A([a-z0-9{sep}]+){sep}{RUN_WORD}(\d+)\z"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def or_else(text: Column, default: str) -> Column:
    """The default in place of an empty text."""
    return F.regexp_replace(text, r"\A\z", default)


def truncate(value: Column, max_length: int | Column) -> Column:
    """Longer values keep `max_length - 5` characters and four hex digits of their SHA-1."""
    limit = F.lit(max_length) if isinstance(max_length, int) else max_length

    def short(v: Column) -> Column:
        digest = F.substring(F.sha1(v), 1, 4)
        head = F.regexp_replace(F.left(v, F.greatest(F.lit(1), limit - 5)), r"-+\z", "")
        return F.when(head == "", F.concat(digest, F.lit("-"), digest)).otherwise(F.concat(head, F.lit("-"), digest))

    return let(value, lambda v: F.when(F.length(v) <= limit, v).otherwise(short(v)))


def slug(value: Column, fallback: str, naming: Naming = Naming(), allow_empty: bool = False) -> Column:
    """Lower-case ASCII letters and digits parted by the separator; other scripts vanish."""
    sep = re.escape(naming.separator)
    ascii_only = strip(F.regexp_replace(F.coalesce(value, F.lit("")), r"[^\x00-\x7F]", ""))
    parted = F.regexp_replace(F.lower(or_else(ascii_only, fallback)), "[^a-z0-9]+", sep)
    trimmed = F.regexp_replace(parted, rf"\A{sep}+|{sep}+\z", "")
    return truncate(trimmed if allow_empty else or_else(trimmed, fallback), naming.max_segment_length)


def last_part(name: Column, default: str) -> Column:
    """What follows the last slash of a model or dataset name."""
    return F.when(F.coalesce(name, F.lit("")) == "", default).otherwise(F.element_at(F.split(name, "/"), -1))


def size_tag(sample_size: Column) -> Column:
    """`full`, or `n` and the number."""
    return F.when(F.coalesce(sample_size, F.lit(0)) == 0, "full").otherwise(
        F.concat(F.lit("n"), sample_size.cast("string"))
    )


def prepared_dir(dataset: Column, sample_size: Column) -> Column:
    """Directory name of a prepared corpus."""
    size = F.when(F.coalesce(sample_size, F.lit(0)) == 0, "full").otherwise(sample_size.cast("string"))
    return F.translate(F.concat(last_part(dataset, "dataset"), F.lit("_"), size), "-", "_")


def legacy_name(model: Column, dataset: Column, sample_size: Column) -> Column:
    """`<dataset>_<size>_<model>` with dashes as underscores."""
    return F.concat_ws(
        "_",
        F.translate(last_part(dataset, "dataset"), "-", "_"),
        size_tag(sample_size),
        F.translate(last_part(model, "model"), "-", "_"),
    )


def join_parts(separator: str, *parts: Column) -> Column:
    return F.concat_ws(separator, *[F.nullif(part, F.lit("")) for part in parts])


def run_suffix(index: Column, naming: Naming) -> Column:
    return F.concat(F.lit(f"{naming.separator}{RUN_WORD}"), index.cast("string"))


def run_prefix(full_prefix: Column, index: Column, naming: Naming) -> Column:
    """The prefix, cut so that the name with its index stays within the longest length."""
    room = F.lit(naming.max_name_length) - F.length(run_suffix(index, naming))
    return or_else(truncate(full_prefix, room), RUN_WORD)


def run_name(full_prefix: Column, index: Column, naming: Naming) -> Column:
    return F.concat(run_prefix(full_prefix, index, naming), run_suffix(index, naming))


def artifact_path(path: Column) -> Column:
    """Override path below the outputs root: plain slashes, no dot parts, no leading `outputs`."""
    parts = F.filter(F.split(F.translate(path, "\\", "/"), "/"), lambda p: ~p.isin("", ".", ".."))
    under = F.lower(F.get(parts, F.lit(0))) == "outputs"
    return F.array_join(F.when(under, F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts), "/")


def owning_run(path: Column, outputs_root: str) -> Column:
    """The run an artefact lies in; null for paths elsewhere."""
    root = re.escape(outputs_root.rstrip("/"))
    return F.nullif(F.regexp_extract(resolve_path(path), rf"\A{root}/([^/]+)", 1), F.lit(""))


def resolve_path(path: Column) -> Column:
    """Absolute path without empty, `.` and `..` parts."""
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    walked = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, p: F.when(p == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(
            F.concat(done, F.array(p))
        ),
    )
    return F.concat(F.lit("/"), F.array_join(walked, "/"))


def parent_path(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*\z", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def resume_candidates(requested: Column, default_path: Column, cwd: str) -> Column:
    """Paths to try for a resume request, in order, without repeats; null for no request."""
    # Parts that only say "here" go first.
    path = F.regexp_replace(slash_path(requested), r"(\A|/)(?:\./)+", "$1")
    first = F.element_at(F.split(path, "/"), 1)
    default_parent = parent_path(default_path)
    below = (
        F.when(
            (first == base_name(default_parent)) & (first != ""),
            F.concat(default_parent, F.lit("/"), F.regexp_replace(path, r"\A[^/]*/?", "")),
        )
        .when(first == base_name(default_path), F.concat(default_parent, F.lit("/"), path))
        .otherwise(F.concat(default_path, F.lit("/"), path))
    )
    tried = (
        F.when(requested == "latest", F.array(default_path))
        .when(path.startswith("/"), F.array(path))
        .otherwise(F.array(F.concat(F.lit(cwd + "/"), path), below))
    )
    wanted = requested.isNotNull() & ~requested.isin("", "null")
    return F.when(wanted, F.array_distinct(F.transform(tried, resolve_path)))
