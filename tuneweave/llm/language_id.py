"""Language identification: family first, then one-versus-one linear SVMs inside the family.

Features are relative frequencies of hashed four-byte grams of the lower-cased
letters of the whole text. One SVM per family (one against the rest) picks the
family; inside it every pair of languages has an SVM, most votes win, then the
larger sum of margins.

The model is fitted on a sample of labelled rows: at most `per_language` rows of
each language and `sample` rows in all, those with the smallest hashes of their
ids. Predictions read whole texts of all rows.

Defined results: a null text, or one without a letter, is `und` with score 0;
with one learned language every other text gets it; with no labelled row all
texts are `und`; repeated rows are predicted alike; existing columns named like
the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneweave.llm.common import four_grams, kept_rows, letters, with_result

BITS = 12
PER_LANGUAGE = 800
SAMPLE = 6400
UNKNOWN = "und"

# Language codes by family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "da de en is nl no sv",
    "romance": "ca es fr gl it pt ro",
    "slavic": "bg cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "turkic": "az kk tr uz",
    "semitic": "ar he mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_other = re.compile(r"[\W\d_]+").sub


def prepared(text: str) -> bytes:
    """Lower-cased words with single spaces around them; digits, marks and signs are gaps."""
    return b" " + _other(" ", text.lower()).strip().encode("utf-8") + b" "


def frequencies(text: str) -> np.ndarray:
    counts = np.zeros(1 << BITS, dtype=np.float64)
    for grams in four_grams(prepared(text), BITS):
        counts += np.bincount(grams, minlength=1 << BITS)
    return counts / counts.sum()


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Linear SVM with squared hinge loss and a bias in the last place; y is +1 or -1, both sides weigh the same."""
    d = x.shape[1]
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    # The bound on the curvature: rows have length one.
    rate = 1.0 / (4.0 + penalty)
    y = y.astype(np.float32)
    w, b = np.zeros(d, np.float32), 0.0
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x @ ahead_w + np.float32(ahead_b))) * weight * y
        next_w = ahead_w + rate * (2 * (slack @ x) - penalty * ahead_w)
        next_b = ahead_b + rate * 2 * float(slack.sum())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w = next_w + (t - 1) / t_next * (next_w - w)
        ahead_b = next_b + (t - 1) / t_next * (next_b - b)
        w, b, t = next_w.astype(np.float32), next_b, t_next
        ahead_w = ahead_w.astype(np.float32)
    return np.append(w, np.float32(b))


@dataclass
class LanguageModel:
    families: list[str]
    members: dict[str, list[str]]
    weights: np.ndarray  # one row per classifier: the families, then the pairs
    pairs: list[tuple[str, str]]

    def margins(self, text: str) -> np.ndarray:
        x = np.sqrt(frequencies(text)).astype(np.float32)
        return self.weights[:, :-1] @ x + self.weights[:, -1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not letters(text):
            return UNKNOWN, 0.0
        margins = self.margins(text)
        k = len(self.families)
        best = int(np.argmax(margins[:k])) if k > 1 else 0
        sure = squash(margins[best]) if k > 1 else 1.0
        family = self.families[best]
        votes = {code: [0, 0.0] for code in self.members[family]}
        for (a, b), margin in zip(self.pairs, margins[k:]):
            if a in votes:
                votes[a if margin >= 0 else b][0] += 1
                votes[a][1] += float(margin)
                votes[b][1] -= float(margin)
        code = min(votes, key=lambda c: (-votes[c][0], -votes[c][1], c))
        if len(votes) > 1:
            sure *= squash(votes[code][1] / (len(votes) - 1))
        return code, float(sure)


def squash(margin: float) -> float:
    return float(1.0 / (1.0 + np.exp(-4.0 * margin)))


def train(features: np.ndarray, langs: list[str]) -> LanguageModel:
    """Model from rows of frequencies; their square roots have length one."""
    x = np.sqrt(features).astype(np.float32)
    codes = sorted(set(langs))
    members: dict[str, list[str]] = {}
    for code in codes:
        members.setdefault(FAMILY_OF.get(code, code), []).append(code)
    families = sorted(members)
    of = np.array([FAMILY_OF.get(c, c) for c in langs])
    names = np.array(langs)
    rows = [fit_svm(x, np.where(of == f, 1.0, -1.0).astype(np.float32)) for f in families] if len(families) > 1 else []
    if len(families) == 1:
        rows = [np.zeros(x.shape[1] + 1, np.float32)]
    pairs = [p for f in families for p in combinations(members[f], 2)]
    for a, b in pairs:
        own = (names == a) | (names == b)
        rows.append(fit_svm(x[own], np.where(names[own] == a, 1.0, -1.0).astype(np.float32)))
    weights = np.array(rows, dtype=np.float32) if rows else np.zeros((0, (1 << BITS) + 1), np.float32)
    return LanguageModel(families, members, weights, pairs)


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> LanguageModel:
    """Fit on (doc_id, text, lang); only the features of the bounded sample reach the driver."""
    usable = labelled.where("lang is not null and text is not null and doc_id is not null")
    # The rows of smallest hash of each of 64 parts of a language, then of the language: none is gathered whole.
    first = ["o", "doc_id", "t"]
    keyed = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("o"), F.xxhash64("text").alias("t")).distinct()
    parts = keyed.withColumn("r", F.row_number().over(Window.partitionBy("lang", F.pmod("t", F.lit(64))).orderBy(*first)))
    ranked = parts.where(F.col("r") <= per_language).withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*first)))
    chosen = ranked.where(F.col("r") <= per_language).orderBy("r", "lang", *first).limit(sample).select("doc_id", "lang", "t")

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([frequencies(t).astype("<f4").tobytes() if letters(t) else None for t in texts], dtype=object)

    # Repeated rows have one hash and count once.
    found = usable.withColumn("t", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "lang", "t"], "left_semi")
    found = found.select("doc_id", "lang", "t", features("text").alias("x")).where("x is not null")
    rows = found.groupBy("doc_id", "lang", "t").agg(F.first("x").alias("x")).collect()
    if not rows:
        return LanguageModel([], {}, np.zeros((0, (1 << BITS) + 1), np.float32), [])
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    return train(np.array([np.frombuffer(r["x"], "<f4") for r in rows]), [r["lang"] for r in rows])


def held_out(key: str) -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of `docs` with a language, with the columns of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return kept_rows(docs, lambda: lambda text: shared.value.predict(text)[0] != UNKNOWN)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            yield pd.DataFrame([own.predict(t) for t in texts], columns=["lang_pred", "score"])

    return with_result(docs, predicted("text"), {"lang_pred": "lang_pred", "score": "score"})
