"""URL filter: rules indexed by their rarest literal token.

A rule is a pattern with a verdict. Each rule is filed under the one of its
literal tokens that the fewest urls hold. The tokens of a url fetch the rules filed
under them; only the regular expressions of those run. Of several rules that fit,
the longest name wins, then a block before an allow, then the smaller name.

The rules are broadcast, so `filter_urls` refuses more than `MAX_RULES` of them
(about 100 MB). Urls are not shuffled; only the counts of tokens that occur in rules are.

Defined results: a null url, or one without `://`, has empty host and path and
fits no rule; urls that fit no rule get `default`; repeated rows are judged alike;
existing columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneweave.llm.common import with_result

MAX_RULES = 500_000
TOKEN = "[a-z0-9]+"
DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str  # for the host followed by the path
    tokens: tuple[str, ...]  # lower-case words between separators that every url it fits must hold
    stated: bool = True  # False: the rule decides, but is not reported as the rule


def host_rule(name: str, verdict: str) -> Rule:
    """`net/es/`: host `net` and all its subdomains, with a path that starts with `/es/`."""
    host, _, path = name.partition("/")
    host, path = host.translate(LOWER), "/" + path
    whole = path if path.endswith("/") else re.sub(r"[A-Za-z0-9]+$", "", path)
    tokens = re.findall(TOKEN, f"{host} {whole}".lower())
    return Rule(name, verdict, rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(dict.fromkeys(tokens)))


def word_rule(word: str, verdict: str) -> Rule:
    """A word between separators anywhere in the host."""
    return Rule(word, verdict, rf"(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?:[^a-z0-9].*)?$", (word,), False)


# Rules that hold where none of the caller's rules fits.
LOWER = {c: c + 32 for c in range(65, 91)}
WORDS = [word_rule(w, "block") for w in "adult bet bets betting casino gambling poker porn sex slots spam viagra xxx".split()]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "".join(map(chr, LOWER)), "".join(chr(c) for c in LOWER.values())), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Urls that hold each of the tokens; those of the rules only, so the result is as bounded as the rules."""
    wanted = urls.sparkSession.sparkContext.broadcast(frozenset(tokens))

    @F.pandas_udf("array<string>")
    def held(texts: pd.Series) -> pd.Series:
        find = re.compile(TOKEN).findall
        return pd.Series([sorted(wanted.value.intersection(find(t.lower()))) for t in texts], dtype=object)

    found = urls.select(F.explode(held(F.concat(host_of(F.col("url")), path_of(F.col("url"))))).alias("token"))
    return {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}


def index(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; a rule without one is filed under the empty token, which every url has."""
    filed: dict[str, list[Rule]] = {}
    for rule in rules:
        token = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        filed.setdefault(token, []).append(rule)
    return filed


def better(rule: Rule, best: Rule | None) -> bool:
    def key(r: Rule) -> tuple:
        return (not r.stated, -len(r.name), r.verdict != "block", r.name)

    return best is None or key(rule) < key(best)


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = DEFAULT) -> DataFrame:
    """`pages` with host, path, rule and verdict of `url`. Unstated rules count only where no stated one fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules are more than are broadcast ({MAX_RULES})")
    names = sorted({t for r in rules for t in r.tokens})
    filed = index(rules, token_counts(pages.select("url"), names))
    shared = pages.sparkSession.sparkContext.broadcast(filed)

    @F.pandas_udf("rule string, verdict string")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = re.compile(TOKEN).findall
        own = {t: [(r, re.compile(r.pattern, re.S).match) for r in found] for t, found in shared.value.items()}
        for texts in batches:
            out = []
            for text in texts:
                best = None
                for token in {"", *find(text.lower())}:
                    for rule, fits in own.get(token, ()):
                        if better(rule, best) and fits(text):
                            best = rule
                out.append((best.name if best and best.stated else None, best.verdict if best else default))
            yield pd.DataFrame(out, columns=["rule", "verdict"])

    host, path = host_of(F.col("url")), path_of(F.col("url"))
    split = with_result(pages, F.struct(host.alias("host"), path.alias("path")), {"host": "host", "path": "path"})
    return with_result(split, judged(F.concat("host", "path")), {"rule": "rule", "verdict": "verdict"})
