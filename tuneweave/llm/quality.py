"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed four-byte grams: one of trusted
texts (a bounded sample of those labelled good) and one of the whole raw corpus.
A text's score is its summed log ratio over its number of grams; every document
with a score of at least `threshold` is kept, so no draw is involved.

Defined results: a null or empty text has no words, all counts are 0, it fails
the base rules and has score 0; repeated rows are judged alike; a document that
is labelled both good and bad is not trusted; without trusted texts all scores are 0; existing
columns named like the results are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneweave.llm.common import four_grams, kept_rows, map_batches, with_result

BITS = 14
TRUSTED = 20_000
THRESHOLD = -0.2
MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def grams(text: str) -> Iterator[np.ndarray]:
    return four_grams(b" " + b" ".join(text.encode("utf-8").split()) + b" ", BITS)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five found twice or more."""
    count = len(words) - REPEAT_WINDOW + 1
    if count < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.uint64)
    mixed = np.zeros(count, np.uint64)
    # Windows are compared by exact rank: each step pairs the rank so far with the next word.
    for k in range(REPEAT_WINDOW):
        mixed = mixed * np.uint64(len(number)) + ids[k : k + count]
        if k and k < REPEAT_WINDOW - 1:
            mixed = np.unique(mixed, return_inverse=True)[1].astype(np.uint64)
    _, inverse, times = np.unique(mixed, return_inverse=True, return_counts=True)
    again = np.flatnonzero(times[inverse] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + REPEAT_WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8").split()
    spaces = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    lines = Counter(line for line in text.split("\n"))
    repeats = sum(n - 1 for line, n in lines.items() if n > 1 and line.encode("utf-8").split())
    return len(words), len(text) - spaces, sum(text.count(c) for c in SYMBOLS), repeats, repeated_words(words)


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > REPEAT_PERCENT * n_words


def counted(texts: Iterator[str | None]) -> np.ndarray:
    total = np.zeros(1 << BITS, np.int64)
    for text in texts:
        if text:
            for g in grams(text):
                total += np.bincount(g, minlength=1 << BITS)
    return total


def trusted_ids(labels: DataFrame, limit: int = TRUSTED) -> DataFrame:
    """At most `limit` ids labelled good, never bad: those with the smallest hashes."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    return good.where("q = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def log_ratios(docs: DataFrame, labels: DataFrame, limit: int = TRUSTED) -> np.ndarray:
    """Log ratio of each bucket, from one pass over all texts; the two multinomials are smoothed alike."""
    ids = frozenset(r["doc_id"] for r in trusted_ids(labels, limit).collect())
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def tally(batches: Iterator[dict]) -> Iterator[dict]:
        raw, good, own = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64), shared.value
        for batch in batches:
            for key, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                counts = counted([value.as_py()])
                raw += counts
                if key in own:
                    good += counts
        yield {"bucket": np.arange(1 << BITS), "raw": raw, "good": good}

    sums = map_batches(docs.select("doc_id", "text"), "bucket int, raw long, good long", tally)
    rows = sums.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()
    raw, good = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for r in rows:
        raw[r["bucket"]], good[r["bucket"]] = r["raw"], r["good"]
    if not good.sum():
        return np.zeros(1 << BITS, np.float32)
    smooth = lambda c: (c + 1.0) / (c.sum() + len(c))
    return np.log(smooth(good) / smooth(raw)).astype(np.float32)


def score(text: str | None, ratios: np.ndarray) -> float:
    if not text:
        return 0.0
    total, n = 0.0, 0
    for g in grams(text):
        total += float(ratios[g].sum(dtype=np.float64))
        n += len(g)
    return total / n


def verdict(text: str | None, ratios: np.ndarray, threshold: float = THRESHOLD) -> tuple:
    """Base counts, base_failed, score and kept of a text."""
    counts = base_counts(text)
    bad, value = failed(counts[0], counts[4]), score(text, ratios)
    return (*counts, bad, value, not bad and value >= threshold)


def kept(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with the columns of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    return kept_rows(docs, lambda: lambda text: verdict(text, shared.value, threshold)[-1])


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with the base counts, base_failed, score and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    fields = ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, score double, kept boolean"

    @F.pandas_udf(fields)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([verdict(t, shared.value, threshold) for t in texts], columns=[*BASE, "base_failed", "score", "kept"])

    names = [*BASE, "base_failed", "score", "kept"]
    return with_result(docs, judged("text"), {n: n for n in names})
