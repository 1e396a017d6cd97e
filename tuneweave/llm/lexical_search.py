"""Ranked lexical search with per-term geometric blocking.

One pass over all documents takes their terms that occur in the queries, and the
statistics of the corpus. Then each task indexes its documents shard by shard: the
posting list of a term is clustered into blocks by similarity of the documents
(random projections of their term scores, each document to its closest pivot), and
each block keeps the maximum of its documents' scores in every coordinate. A query opens its
lists from the one with the highest possible score down, until the lists that are left
cannot lift a document into its best k. In an opened list a block is skipped only when
the exact sum of its maxima over the query's terms is below the k-th best score known; the other
blocks' documents are scored exactly. So no answer is lost. Shards bound memory and
split the lists of common terms; only the best k of each task and query are shuffled.

Queries are taken in blocks of at most 1,024 items and about 4 MB of text; what is
broadcast is bounded by a block's terms.

Defined results: null or empty texts and texts without a term match nothing and are not
counted in the statistics; an item without terms has no rows; repeated items are
answered one by one; repeated documents are all ranked, those without doc_id before others of the same
score (doc_id must not be the least 64-bit integer); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tuneweave.llm.common import map_batches
from tuneweave.llm.vectors import SPACE, Words, binary, byte_array, ranges, steps
from tuneweave.session import scratch_path, stored

K = 20
ITEMS = 1024
ITEM_BYTES = 4 << 20
SHARD_ROWS = 8192
SHARD_ENTRIES = 1 << 21
# Documents that a block is meant to hold, and dimensions of the projections.
BLOCK = 24
DIMENSIONS = 24
# Documents whose scores give the first thresholds.
WARM = 4096
NO_ID = np.iinfo(np.int64).min
FORWARD = "doc_id long, n long, terms binary, tfs binary, stats binary"
FOUND = "item int, doc_id long, score long"
# Letters and digits of ASCII and all other characters; only A-Z are lower-cased.
TABLE = bytes(i if i >= 128 or chr(i).isalnum() else SPACE for i in range(256)).lower()


class Queries:
    """A block of items: their terms and how often each item has each."""

    def __init__(self, texts: list[str | None]):
        words = Words(pa.array(texts, pa.string()), TABLE)
        coded = words.values.dictionary_encode()
        self.terms = coded.dictionary.to_pylist()
        ids, width = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(len(self.terms), 1)
        keys, times = np.unique(words.text * width + ids, return_counts=True)
        owner = keys // width
        self.items = []
        for i in range(len(texts)):
            lo, hi = np.searchsorted(owner, [i, i + 1])
            self.items.append((keys[lo:hi] % width, times[lo:hi].astype(np.int64)))


def forward(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Terms of the queries in each document with their frequencies, and per partition one row of statistics: documents, terms, df of each."""
    shared, width = docs.sparkSession.sparkContext.broadcast(terms), max(len(terms), 1)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        known, stats = pa.array(shared.value, pa.large_binary()), np.zeros(width + 2, np.int64)
        for batch in steps(batches, "text"):
            rows = len(batch["text"])
            words = Words(batch["text"], TABLE)
            counts = np.bincount(words.text, minlength=rows)
            ids = pc.index_in(words.values, value_set=known)
            hit = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
            ids = ids.fill_null(0).to_numpy().astype(np.int64)
            keys, tfs = np.unique(words.text[hit] * width + ids[hit], return_counts=True)
            owner, term = keys // width, keys % width
            stats[0] += np.count_nonzero(counts)
            stats[1] += counts.sum()
            stats[2:] += np.bincount(term, minlength=width)
            held, sizes = np.unique(owner, return_counts=True)
            ends = 4 * np.append(0, np.cumsum(sizes))
            yield {
                "doc_id": batch["doc_id"].take(pa.array(held)),
                "n": counts[held],
                "terms": binary(term.astype("<i4"), ends),
                "tfs": binary(tfs.astype("<i4"), ends),
                "stats": pa.nulls(len(held), pa.binary()),
            }
        yield {"doc_id": [None], "n": [0], "terms": [None], "tfs": [None], "stats": [stats.astype("<i8").tobytes()]}

    return stored(map_batches(docs.select("doc_id", "text"), FORWARD, run), "forward")


def statistics(rows: DataFrame, width: int) -> np.ndarray:
    """Documents with a term, all terms, and the document frequency of each term of the queries."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            for s in batch["stats"]:
                total += np.frombuffer(s.as_buffer(), "<i8")
        at = np.flatnonzero(total)
        yield {"place": at, "n": total[at]}

    parts = map_batches(rows.where("stats is not null").select("stats"), "place long, n long", run)
    total = np.zeros(width + 2, np.int64)
    for r in parts.groupBy("place").agg(F.sum("n").alias("n")).collect():
        total[r["place"]] = r["n"]
    return total


class Scores:
    """Scores of term frequencies by the statistics of the corpus."""

    def __init__(self, stats: np.ndarray):
        self.docs, self.length = int(stats[0]), max(int(stats[1]), 1)
        weights = [math.floor(1000 * math.log((2 * self.docs + 2) / (2 * int(df) + 1))) for df in stats[2:]]
        self.weights = np.array(weights, np.int64)

    def __call__(self, n: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = 75 + (25 * n * self.docs) // self.length
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


class Best:
    """The k best (score, doc_id) of an item so far."""

    def __init__(self, k: int, floor: int = 1):
        self.k, self.floor = k, max(floor, 1)
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        use = scores >= self.floor
        scores, ids = np.concatenate([self.scores, scores[use]]), np.concatenate([self.ids, ids[use]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


class Shard:
    """Documents of a shard, their posting lists, and the blocks of the lists that were opened."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, term: np.ndarray, score: np.ndarray, width: int):
        self.ids, self.ends, self.term, self.score, self.width = ids, ends, term, score, width
        sizes = np.diff(ends)
        owner = np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(term, kind="stable")
        self.postings = owner[order]
        self.lists = np.searchsorted(term[order], np.arange(width + 1))
        self.top = np.zeros(width, np.int64)
        np.maximum.at(self.top, term, score)
        signs = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (width, DIMENSIONS))
        rows = signs[term] * score[:, None].astype(np.float32)
        self.sketch = np.add.reduceat(rows, ends[:-1]) if len(ids) else np.zeros((0, DIMENSIONS), np.float32)
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-9)
        self.opened: dict[int, tuple] = {}

    def blocks(self, t: int) -> tuple:
        """Blocks of the list of term t: documents, their bounds, and the coordinates and maxima of all summaries with their bounds."""
        if t in self.opened:
            return self.opened[t]
        docs = self.postings[self.lists[t] : self.lists[t + 1]]
        count = -(-len(docs) // BLOCK)
        pivots = self.sketch[docs[:: max(1, len(docs) // count)][:count]]
        near = np.concatenate([(self.sketch[docs[i : i + 4096]] @ pivots.T).argmax(1) for i in range(0, len(docs), 4096)])
        order = np.argsort(near, kind="stable")
        docs, near = docs[order], near[order]
        cuts = np.append(np.flatnonzero(np.append(True, near[1:] != near[:-1])), len(docs))
        sizes = self.ends[docs + 1] - self.ends[docs]
        at = ranges(self.ends[docs], sizes)
        keys = np.repeat(np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), sizes) * self.width + self.term[at]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        most = np.maximum.reduceat(self.score[at][order], first)
        keys = keys[first]
        bounds = np.searchsorted(keys, np.arange(len(cuts) - 1) * self.width)
        self.opened[t] = docs, cuts, keys % self.width, most, bounds
        return self.opened[t]

    def search(self, terms: np.ndarray, times: np.ndarray, best: Best, weight: np.ndarray) -> None:
        """Adds this shard's documents to the best of a query; `weight` is scratch space of zeros, one for each term."""
        held = self.top[terms] > 0
        terms, times = terms[held], times[held]
        most = times * self.top[terms]
        order = np.argsort(-most, kind="stable")
        terms, times, most = terms[order], times[order], most[order]
        # The most that a document without any of the terms before this one can score.
        rest = np.cumsum(most[::-1])[::-1]
        seen = np.zeros(len(self.ids), bool)
        weight[terms] = times
        for t, possible in zip(terms.tolist(), rest.tolist()):
            if possible < best.floor:
                break
            docs, cuts, coordinates, maxima, bounds = self.blocks(t)
            limit = np.add.reduceat(weight[coordinates] * maxima, bounds)
            by_limit = np.argsort(-limit, kind="stable")
            # The most promising blocks first, twice as many each time: their scores raise the limit for the rest.
            at, width = 0, 4
            while at < len(by_limit):
                some = by_limit[at : at + width]
                some = some[limit[some] >= best.floor]
                if not len(some):
                    break
                found = docs[ranges(cuts[some], cuts[some + 1] - cuts[some])]
                found = found[~seen[found]]
                if len(found):
                    seen[found] = True
                    sizes = self.ends[found + 1] - self.ends[found]
                    entries = ranges(self.ends[found], sizes)
                    scores = np.add.reduceat(weight[self.term[entries]] * self.score[entries], np.cumsum(sizes) - sizes)
                    best.add(scores, self.ids[found])
                at, width = at + width, 2 * width
        weight[terms] = 0


def shards(batches: Iterator[dict], score: Scores, width: int) -> Iterator[Shard]:
    held, rows, entries = [], 0, 0

    def built() -> Shard:
        n = np.concatenate([h[1] for h in held])
        sizes = np.concatenate([h[2] for h in held])
        term = np.concatenate([h[3] for h in held]).astype(np.int64)
        values = score(np.repeat(n, sizes), term, np.concatenate([h[4] for h in held]).astype(np.int64))
        return Shard(np.concatenate([h[0] for h in held]), np.append(0, np.cumsum(sizes)), term, values, width)

    for batch in batches:
        for at in range(0, len(batch["n"]), 1024):
            part = {k: v.slice(at, 1024) for k, v in batch.items()}
            terms, ends = byte_array(part["terms"])
            tfs, _ = byte_array(part["tfs"])
            ids = part["doc_id"].fill_null(NO_ID).to_numpy()
            held.append((ids, part["n"].to_numpy(), np.diff(ends) // 4, terms.copy().view("<i4"), tfs.copy().view("<i4")))
            rows, entries = rows + len(ids), entries + len(terms) // 4
            if rows >= SHARD_ROWS or entries >= SHARD_ENTRIES:
                yield built()
                held, rows, entries = [], 0, 0
    if held:
        yield built()


def best_of(rows: DataFrame, queries: Queries, score: Scores, k: int, floors: list[int]) -> DataFrame:
    """The best k of every task for each item with a score of at least its floor."""
    shared, width = rows.sparkSession.sparkContext.broadcast((queries.items, score, floors)), max(len(queries.terms), 1)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        items, own, least = shared.value
        best, weight = [Best(k, f) for f in least], np.zeros(width, np.int64)
        for shard in shards(batches, own, width):
            for (terms, times), b in zip(items, best):
                shard.search(terms, times, b, weight)
        ids = np.concatenate([b.ids for b in best])
        yield {
            "item": np.repeat(np.arange(len(best)), [len(b.ids) for b in best]),
            "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
            "score": np.concatenate([b.scores for b in best]),
        }

    return map_batches(rows.where("stats is null").drop("stats"), FOUND, run)


def first_of(rows: DataFrame, k: int) -> DataFrame:
    """The best k rows of each item, ranked; first in 16 parts of an item's rows."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    parts = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id", "score"), F.lit(16))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= k).drop("rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def blocks_of(items: DataFrame) -> Iterator[list]:
    """Items in blocks of bounded number and text size, fetched part by part."""
    held, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        held.append(row)
        size += len(row["text"] or "")
        if len(held) >= ITEMS or size >= ITEM_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    folder = scratch_path(spark, "answers")
    names = f"item_id {kind}, rank int, doc_id long, score long"
    spark.createDataFrame([], names).write.parquet(folder)
    for block in blocks_of(items):
        queries = Queries([r["text"] for r in block])
        rows = forward(docs, queries.terms)
        score = Scores(statistics(rows, max(len(queries.terms), 1)))
        # Scores of some documents are lower bounds of the k-th best; which ones only decides how much is skipped.
        some = rows.where("stats is null").orderBy(F.xxhash64("terms"), "doc_id").limit(WARM).coalesce(1)
        floors = [1] * len(block)
        for r in first_of(best_of(some, queries, score, k, floors), k).where(F.col("rank") == k).collect():
            floors[r["item"]] = r["score"]
        ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"item int, item_id {kind}")
        found = first_of(best_of(rows, queries, score, k, floors), k).join(F.broadcast(ids), "item")
        found.select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(folder)
    return spark.read.schema(names).parquet(folder)
