"""Approximate nearest neighbours by learned partitions, for the inner product.

A neighbour graph over a bounded sample is cut into equally large partitions with few
edges between them. A softmax classifier learns which partitions a vector's
neighbours lie in. Every vector is filed under its most probable partition; a query is
routed to several, and all vectors found there are ranked by their exact inner product.
The number of partitions probed is the smallest that reaches the wanted recall on sample rows
the classifier has not seen.

Equal vectors are one entry that lists the smallest ids (one more than the
answers wanted), so a vector with very many copies is no hot spot.

Defined results: vectors that are null, empty or zero, hold null or non-finite
components, or have another length than most vectors take no part, nor do rows
without an id; rows that repeat id and vector count once; a table with fewer candidates gives
all of them; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneweave.llm.common import map_batches
from tuneweave.session import stored

SAMPLE = 8192
PARTITIONS = 64
NEIGHBOURS = 10
RECALL = 0.97
BLOCK = 2048  # vectors of a partition in one block
QUERIES = 256  # queries in one block


def usable(vector: Column, length: int) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (F.size(vector) == length) & fine & F.exists(vector, lambda v: v != 0)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k nearest other rows."""
    n = len(x)
    k = min(k, n - 1)
    found = np.empty((n, k), np.int64)
    for start in range(0, n, 1024):
        near = x[start : start + 1024] @ x.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        found[start : start + len(near)] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return found


def halve(rows: np.ndarray, graph: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of `rows` with few edges between: the second eigenvector by power iteration, then gainful swaps."""
    n = len(rows)
    place = np.full(len(graph), -1, np.int64)
    place[rows] = np.arange(n)
    a = np.repeat(np.arange(n), graph.shape[1])
    b = place[graph[rows]].ravel()
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.r_[a, b], np.r_[b, a]
    degree = np.bincount(a, minlength=n) + 1e-9
    v = np.random.default_rng(seed).standard_normal(n)
    for _ in range(40):
        v -= (v * degree).sum() / degree.sum()
        v = 0.5 * v + 0.5 * np.bincount(a, v[b], minlength=n) / degree
        v /= np.abs(v).max() + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    for _ in range(8):
        across = np.bincount(a, side[a] != side[b], minlength=n)
        gain = 2 * across - np.bincount(a, minlength=n)
        left, right = np.flatnonzero(~side & (gain > 0)), np.flatnonzero(side & (gain > 0))
        m = min(len(left), len(right)) // 2
        if m == 0:
            break
        side[left[np.argsort(-gain[left], kind="stable")[:m]]] = True
        side[right[np.argsort(-gain[right], kind="stable")[:m]]] = False
    return rows[~side], rows[side]


def balanced_partitions(graph: np.ndarray, parts: int) -> np.ndarray:
    pieces = [np.arange(len(graph))]
    while len(pieces) < parts:
        pieces = [half for i, p in enumerate(pieces) for half in halve(p, graph, i)]
    label = np.zeros(len(graph), np.int64)
    for i, p in enumerate(pieces):
        label[p] = i
    return label


@dataclass
class Router:
    weights: np.ndarray  # dimension + 1 rows, one column per partition
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1] + self.weights[-1]


def fit_router(x: np.ndarray, target: np.ndarray, steps: int = 150) -> np.ndarray:
    """Softmax regression onto the share of neighbours in each partition, by Adam on the whole sample."""
    x = np.c_[x, np.ones(len(x), x.dtype)]
    w = np.zeros((x.shape[1], target.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = x @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        grad = x.T @ (z / z.sum(axis=1, keepdims=True) - target) / np.float32(len(x))
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w = w - np.float32(0.1) * (m / np.float32(1 - 0.9**step)) / (np.sqrt(v / np.float32(1 - 0.999**step)) + np.float32(1e-8))
    return w


def learn(sample: np.ndarray, parts: int = PARTITIONS, recall: float = RECALL) -> Router:
    """Router from sample vectors; parts is a power of two and falls until a partition has 32 rows of the sample."""
    while parts > 1 and len(sample) < 32 * parts:
        parts //= 2
    if parts == 1:
        return Router(np.zeros((sample.shape[1] + 1, 1), np.float32), 1)
    scale = np.sqrt((sample.astype(np.float64) ** 2).sum(axis=1).mean())
    x = (sample / scale).astype(np.float32)
    check = np.arange(len(x)) % 8 == 0
    train = x[~check]
    graph = neighbour_graph(train, NEIGHBOURS)
    label = balanced_partitions(graph, parts)
    target = np.zeros((len(train), parts), np.float32)
    for column in graph.T:
        target[np.arange(len(train)), label[column]] += 1
    target[np.arange(len(train)), label] += 1
    weights = fit_router(train, target / target.sum(axis=1, keepdims=True))
    router = Router(weights, parts)
    # Where the true neighbours of the rows kept back are filed, by rank of the partition for the query.
    near = x[check] @ train.T
    true = np.argpartition(-near, min(NEIGHBOURS, len(train) - 1), axis=1)[:, :NEIGHBOURS]
    filed = router.scores(train).argmax(axis=1)
    rank = np.empty((int(check.sum()), parts), np.int64)
    order = np.argsort(-router.scores(x[check]), axis=1, kind="stable")
    np.put_along_axis(rank, order, np.arange(parts)[None, :], axis=1)
    needed = np.take_along_axis(rank, filed[true], axis=1)
    reached = np.array([(needed < p).mean() for p in range(1, parts + 1)])
    router.probes = int(np.argmax(reached >= recall)) + 1
    router.weights = np.vstack([weights[:-1] / np.float32(scale), weights[-1:]])
    return router


def entries(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids; Spark keeps only as many of a vector in each task before the shuffle."""
    ranked = vectors.distinct().withColumn("r", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id")))
    return (
        ranked.where(F.col("r") <= k + 1)
        .groupBy("embedding")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(F.element_at("ids", 1).alias("entry"), "ids", "embedding")
    )


def matrix(column, length: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, length) if len(column) else np.empty((0, length))


def search(vectors: DataFrame, is_query: Column, k: int = 20, sample: int = SAMPLE, parts: int = PARTITIONS, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for each row where `is_query` holds."""
    spark = vectors.sparkSession
    # The bounded sample alone reaches the driver.
    rows = vectors.where("vec_id is not null and embedding is not null").select("vec_id", F.col("embedding").cast("array<double>"))
    common = rows.groupBy(F.size("embedding").alias("n")).count().where("n > 0").orderBy(F.desc("count"), "n").first()
    length = common["n"] if common else 0
    rows = rows.where(usable(F.col("embedding"), length))
    index = stored(entries(rows, k), "entries")
    picked = index.orderBy(F.xxhash64("entry"), "entry").limit(sample).select("embedding").collect()
    router = learn(np.array([r["embedding"] for r in picked])) if picked else Router(np.zeros((length + 1, 1), np.float32), 1)
    if picked and (parts, recall) != (PARTITIONS, RECALL):
        router = learn(np.array([r["embedding"] for r in picked]), parts, recall)
    shared = spark.sparkContext.broadcast(router)

    def file(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            x = matrix(batch["embedding"], length)
            part = shared.value.scores(x).argmax(axis=1) if len(x) else np.empty(0, np.int64)
            yield {"part": part, "entry": batch["entry"], "ids": batch["ids"], "embedding": batch["embedding"]}

    def route(batches: Iterator[dict]) -> Iterator[dict]:
        own = shared.value
        for batch in batches:
            x = matrix(batch["embedding"], length)
            order = np.argsort(-own.scores(x), axis=1, kind="stable")[:, : own.probes]
            at = np.repeat(np.arange(len(x)), order.shape[1])
            yield {
                "part": order.ravel(),
                "entry": batch["entry"].to_numpy()[at],
                "ids": [[]] * len(at),
                "embedding": list(x[at]),
            }

    layout = "part int, entry long, ids array<long>, embedding array<double>"
    filed = map_batches(index.select("entry", "ids", "embedding"), layout, file)
    # A query's entry is found by its own vector, so equal queries are searched once.
    asked = rows.where(is_query).select("vec_id", "embedding").distinct().join(index.select("entry", "embedding"), "embedding")
    asked = stored(asked.select("vec_id", "entry", "embedding"), "asked")
    queries = map_batches(asked.select("entry", "embedding").distinct(), layout, route)

    def packed(df: DataFrame, size: int) -> DataFrame:
        """Blocks of at most `size` vectors of one partition; a partition is dealt over several tasks by entry."""
        dealt = df.withColumn("salt", F.pmod(F.xxhash64("entry"), F.lit(8))).repartition("part", "salt").sortWithinPartitions("part", "entry")

        def run(batches: Iterator[dict]) -> Iterator[dict]:
            held: dict = {"part": None, "entry": [], "ids": [], "x": []}

            def out() -> dict:
                return {"part": [held["part"]], "entries": [held["entry"]], "ids": [held["ids"]], "data": [np.concatenate(held["x"]).tobytes()]}

            for batch in batches:
                x = matrix(batch["embedding"], length)
                for i, (part, entry, ids) in enumerate(zip(*(batch[c].to_pylist() for c in ("part", "entry", "ids")))):
                    if held["entry"] and (part != held["part"] or len(held["entry"]) >= size):
                        yield out()
                        held.update(entry=[], ids=[], x=[])
                    held["part"] = part
                    held["entry"].append(entry)
                    held["ids"].append(ids)
                    held["x"].append(x[i])
            if held["entry"]:
                yield out()

        return map_batches(dealt.drop("salt"), "part int, entries array<long>, ids array<array<long>>, data binary", run)

    known = stored(packed(filed, BLOCK), "filed")
    wanted = packed(queries, QUERIES).select("part", F.col("entries").alias("queries"), F.col("data").alias("asked"))

    def rank(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for ids, data, queries_, asked_ in zip(*(batch[c].to_pylist() for c in ("ids", "data", "queries", "asked"))):
                x = np.frombuffer(data).reshape(-1, length)
                q = np.frombuffer(asked_).reshape(-1, length)
                near = q @ x.T
                out: dict[str, list] = {"entry": [], "score": [], "ids": []}
                for i, entry in enumerate(queries_):
                    row = near[i]
                    if len(row) > k + 1:
                        floor = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                        best = np.flatnonzero(row >= floor - 1e-9 * (1 + abs(floor)))
                    else:
                        best = np.arange(len(row))
                    # The same order of additions for every vector, so that equal vectors tie.
                    exact = (x[best] * q[i]).sum(axis=1)
                    out["entry"] += [entry] * len(best)
                    out["score"] += exact.tolist()
                    out["ids"] += [ids[b] for b in best.tolist()]
                yield out

    found = map_batches(known.join(wanted, "part").select("ids", "data", "queries", "asked"), "entry long, score double, ids array<long>", rank)
    found = found.select("entry", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("entry").orderBy(F.desc("score"), "vec_id")
    # One more than wanted, as a query's own row is among them.
    best = stored(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1), "nearest")
    asked = asked.select(F.col("vec_id").alias("query_id"), "entry")
    answers = asked.join(best, "entry").where("query_id != vec_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
