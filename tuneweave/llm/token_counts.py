"""Token counts without ids: pieces are counted once per distinct pre-token.

A text is cut where no vocabulary entry can reach across: before runs of spaces
and before line feeds. The number of pieces of a pre-token therefore does not
depend on its neighbours. Counts of pre-tokens that make up at least
1/2^18 of the corpus (so at most 2^18 of them) are broadcast; all others are
shuffled with their per-document frequencies, each distinct one is counted once,
and the products are summed per document.

Defined results: a null or empty text has 0 bytes and 0 tokens; each row of the
input gives one row, repeated rows too; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneweave.llm.common import Frequent, map_batches
from tuneweave.session import stored

SHARE = 2.0**-18
LIMIT = 4096
SPACE = "▁"
_runs = re.compile("\n[^ \n]*| +[^ \n]*").findall


def check_cuts(path: str) -> None:
    """Refuse a model in which an entry could reach across a cut."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if re.search(f"[^{SPACE}]{SPACE}", piece) or "\n" in piece:
            raise ValueError(f"entry {piece!r} reaches across pre-tokens")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text, without the one space before each; those that follow a line feed start with it."""
    text = text.replace(SPACE, " ")
    if not text:
        return []
    if text[0] == " " or "  " in text:
        return [t[1:] if t[0] == " " else t for t in _runs(" " + text)]
    return text.replace("\n", " \n").split(" ")


def piece_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts the pieces of pre-tokens; the library puts the one space before each text that `pre_tokens` took off."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def count(tokens: list[str]) -> list[int]:
        ids = model.encode(tokens, num_threads=1)
        return [1 if not t else len(i) - (t[0] == "\n") for t, i in zip(tokens, ids)]

    return count


def frequent_counts(docs: DataFrame, text: Column, path: str, share: float) -> dict[str, int]:
    """Pieces of the pre-tokens with at least `share` of all pre-tokens of the corpus: at most 1 / share entries."""

    def tally(batches: Iterator[dict]) -> Iterator[dict]:
        own = Frequent(share)
        for batch in batches:
            for t in batch["text"]:
                tokens = pre_tokens(t.as_py())
                own.add(tokens, len(tokens))
        held = own.result()
        yield {"token": ["", *held], "n": [own.seen, *held.values()], "total": [True, *[False] * len(held)]}

    parts = map_batches(docs.select(text.alias("text")), "token string, n long, total boolean", tally)
    sums = stored(parts.groupBy("token", "total").agg(F.sum("n").alias("n")), "pretokens")
    total = sums.where("total").agg(F.sum("n")).first()[0] or 0

    def measure(batches: Iterator[dict]) -> Iterator[dict]:
        count = piece_counter(path)
        for batch in batches:
            yield {"token": batch["token"], "n": count(batch["token"].to_pylist())}

    often = sums.where(~F.col("total") & (F.col("n") >= max(1.0, total * share)))
    return {r["token"]: r["n"] for r in map_batches(often, "token string, n long", measure).collect()}


def count_tokens(docs: DataFrame, path: str, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document, for the sentencepiece model at `path`."""
    check_cuts(path)
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    known = spark.sparkContext.broadcast(frequent_counts(docs, text, path, share))

    def split(batches: Iterator[dict]) -> Iterator[dict]:
        """One row with what is known of each text, and one for each of its rare pre-tokens."""
        table, row = known.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            keys, first = batch["doc_id"].to_pylist(), row
            rows, tokens, times, ids, sizes = [], [], [], [], []
            for key, value in zip(keys, batch["text"]):
                content = value.as_py()
                total, rest = 0, []
                for token in pre_tokens(content):
                    n = table.get(token)
                    if n is None:
                        rest.append(token)
                    else:
                        total += n
                found = Counter(rest)
                rows += [row] * (len(found) + 1)
                tokens.append(None)
                tokens += found
                times.append(total)
                times += found.values()
                ids.append(key)
                ids += [None] * len(found)
                sizes.append(len(content.encode("utf-8")))
                sizes += [None] * len(found)
                row += 1
            if row > first:
                yield {"row": rows, "token": tokens, "times": times, "doc_id": ids, "n_bytes": sizes}

    # A row of its own for each text keeps repeated ids apart; its number does not depend on when the task runs.
    parts = map_batches(docs.select("doc_id", text.alias("text")), "row long, token string, times long, doc_id long, n_bytes long", split)
    dealt = parts.repartition(F.coalesce("token", F.col("row").cast("string"))).sortWithinPartitions("token")

    def measure(batches: Iterator[dict]) -> Iterator[dict]:
        count, last, size = piece_counter(path), None, 0
        for batch in batches:
            tokens = batch["token"].to_pylist()
            fresh = list(dict.fromkeys(t for t in tokens if t is not None and t != last))
            sizes = dict(zip(fresh, count(fresh)))
            sizes.setdefault(last, size)
            sizes[None] = 1
            if tokens:
                last, size = tokens[-1], sizes[tokens[-1]]
            n = [sizes[t] * k for t, k in zip(tokens, batch["times"].to_pylist())]
            yield {"row": batch["row"], "n": n, "doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"]}

    counted = map_batches(dealt, "row long, n long, doc_id long, n_bytes long", measure)
    sums = counted.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return sums.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
