"""Packing by concatenate and cut.

Pass 1 tokenises every document once and writes, per input partition, each
document's ids with its offset inside the partition. The partitions' token
totals get a prefix sum, which turns these into global offsets. Pass 2 cuts the
stream of all ids into windows of `width` ids; where a window ends inside a
document, the boundary gives two records of that document. No text and no id is
shuffled, and only one row per input partition is broadcast.

Defined results: a null or empty text is only the separator id; only the last
sequence can be short; repeated rows are separate documents; other columns are
ignored; an empty table gives no pieces. The order of documents is that of the
input partitions.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tuneweave.llm.common import map_batches
from tuneweave.llm.vectors import Coder, binary, byte_array, ranges, space_chunks, steps
from tuneweave.session import stored

WIDTH = 1024
SEPARATOR = 0
TOKENISED = "doc_id long, part long, local long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_encoders: dict[str, Callable] = {}


def context_free(path: str) -> bool:
    """Whether the file's ids before each space do not depend on what follows: byte-level BPE cut by its usual pattern."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cut = spec.get("pre_tokenizer") or {}
    usual = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    plain = not any(t.get("lstrip") or t.get("rstrip") or " " in t.get("content", "") for t in spec.get("added_tokens") or [])
    return usual and plain and spec.get("normalizer") is None


def load_tokenizer(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Function from texts to all their ids in a row and the number of each, by a tokenizers file; one per worker process.

    The library's own threads stay off, as Spark runs the tasks in parallel. With
    byte-level BPE a text is the chain of its chunks that begin with a space, unless a
    space stands between other white space; so each distinct chunk is encoded once.
    """
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        own, free = Tokenizer.from_file(path), context_free(path)
        coder = Coder(lambda chunks: [e.ids for e in own.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)])

        def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            n = len(texts)
            return coder.ids(*space_chunks(texts), n) if free else coder.ids(texts.cast(pa.large_binary()).fill_null(b""), np.arange(n), n)

        _encoders[path] = run
    return _encoders[path]


def tokenised(docs: DataFrame, load: Callable, separator: int = SEPARATOR) -> DataFrame:
    """Ids (little-endian, 32 bits) of every document with the offset inside its partition, written once."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        encode, part, local = load(), TaskContext.get().partitionId(), 0
        for batch in steps(batches, "text"):
            ids, lengths = encode(batch["text"])
            ids = np.insert(ids, np.cumsum(lengths), np.uint32(separator))
            ends = np.append(0, np.cumsum(lengths + 1))
            yield {
                "doc_id": batch["doc_id"],
                "part": np.full(len(lengths), part),
                "local": local + ends[:-1],
                "doc_tokens": lengths + 1,
                "ids": binary(ids.astype("<u4"), 4 * ends),
            }
            local += int(ends[-1])

    return stored(map_batches(docs.select("doc_id", "text"), TOKENISED, run), "tokenised")


def bases(tokens: DataFrame) -> DataFrame:
    """First global offset of each partition: a running sum over one row per partition."""
    totals = tokens.groupBy("part").agg(F.max(F.col("local") + F.col("doc_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def pack(docs: DataFrame, load: Callable, width: int = WIDTH, separator: int = SEPARATOR) -> DataFrame:
    """One row per piece of a document in a sequence of `width` ids.

    Only the bases are broadcast: one row of 16 bytes per input partition, so
    13 MB for 100 TB in partitions of 128 MB.
    """
    tokens = tokenised(docs, load, separator)
    placed = tokens.join(F.broadcast(bases(tokens)), "part").select(
        "doc_id", "doc_tokens", "ids", (F.col("base") + F.col("local")).alias("first")
    )

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            first, n = batch["first"].to_numpy(), batch["doc_tokens"].to_numpy()
            count = (first + n - 1) // width - first // width + 1
            row = np.repeat(np.arange(len(n)), count)
            sequence = first[row] // width + ranges(np.zeros(len(n), np.int64), count)
            start = np.maximum(sequence * width - first[row], 0)
            length = np.minimum((sequence + 1) * width - first[row], n[row]) - start
            data, ends = byte_array(batch["ids"])
            data, at = memoryview(np.ascontiguousarray(data)), (ends[row] + 4 * start).tolist()
            take = pa.array(row)
            yield {
                "doc_id": batch["doc_id"].take(take),
                "start": start,
                "length": length,
                "ids_crc32": [zlib.crc32(data[i : i + size]) for i, size in zip(at, (4 * length).tolist())],
                "doc_tokens": batch["doc_tokens"].take(take),
                "sequence_id": sequence,
                "offset": first[row] + start - sequence * width,
            }

    return map_batches(placed, PIECES, cut)
