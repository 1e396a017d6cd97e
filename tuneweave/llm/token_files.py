"""Token ids of a corpus in binary files.

Format: ids are replaced by their rank in the corpus, the most frequent id first (equal
frequencies by id). A rank takes one to four bytes, lowest byte first, without its leading
zero bytes. The byte counts, less one, stand apart in control bytes: two bits for each
rank, four ranks in a control byte, the first in its lowest bits. A file is a run of
blocks of whole documents, about 65,536 ids each: ids and lengths of its documents,
control bytes, data bytes. Files, blocks and documents are in ascending order of doc_id.
The folder holds the blocks as binary columns of uncompressed Parquet files, so that Spark's
commit protocol and file systems carry them, and the ranks as a small table. Decoding looks
control bytes up in a table of their byte counts and ranks in the table of ids.

Pass 1 tokenises each document once and counts ids; each input partition adds one row with its
counts. Pass 2 deals the ids out by ranges of (doc_id, input partition, row), so a
repeated doc_id does not end in one task, and writes the blocks. Only the ranks, bounded by the vocabulary, and one row
per file are broadcast.

Defined results: a null or empty text is only the end id; documents without doc_id come
first; repeated ids and rows are documents of their own, in the order of input partitions and rows; other
columns are ignored; an empty table gives no files to read but a valid folder.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tuneweave.llm.common import map_batches
from tuneweave.llm.vectors import Coder, Words, binary, byte_array, steps, to_spaces
from tuneweave.session import scratch_path, stored

END = 2
BLOCK = 1 << 16
FILE = 1 << 26
# No file gets fewer ids than this to keep all cores busy.
LEAST = 1 << 20
# Chunks that the library gets as one text.
JOINT = 64
TOKENISED = "doc_id long, part int, row long, n long, wide boolean, ids binary, counts binary"
BLOCKS = "file int, block int, first long, n_ids long, n_docs long, no_id long, doc_ids binary, lengths binary, control binary, data binary"
READ = "doc_id long, start long, n_tokens long, ids binary"
BYTES = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)
_coders: dict[tuple, Callable] = {}

# Normaliser and first cut of a tokenizer that drops white space and lets nothing reach across it (fixed values).
_WORDS_ONLY = [
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
]


def drops_white_space(path: str) -> bool:
    """Whether the tokenizer encodes a text as the chain of its words between white space."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    normal = (spec.get("normalizer") or {}).get("normalizers")
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
    added = spec.get("added_tokens") or []
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("normalized") or set(t["content"]) & set(" \t\n\r") for t in added)
    return [normal, cuts[0]] == _WORDS_ONLY and plain and not spec.get("post_processor")


def mark_of(own) -> tuple[str, int] | None:
    """An added token of a tokenizer, with its id, that the library finds wherever it is put between texts."""
    added = own.get_added_tokens_decoder()
    names = [t.content for t in added.values()]
    for number, t in added.items():
        apart = not any(t.content[0] in n[1:] or (n != t.content and n.startswith(t.content)) for n in names)
        if apart and not (t.single_word or t.lstrip or t.rstrip or t.normalized):
            return t.content, number
    return None


def joint_encoder(own, mark: tuple[str, int] | None) -> Callable[[list[bytes]], list[list[int]]]:
    """Function from chunks to the ids of each; with `mark`, the library gets many chunks as one text, each ended by that added token.

    The library cuts a text at its added tokens first and encodes each part by itself, and one more
    text costs it more than a short chunk. Rows with a chunk that holds the mark are encoded chunk by chunk.
    """

    def singly(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(chunks: list[bytes]) -> list[list[int]]:
        texts = [c.decode("utf-8") for c in chunks]
        if mark is None:
            return singly(texts)
        name, number = mark
        rows = [texts[i : i + JOINT] for i in range(0, len(texts), JOINT)]
        found: list[list[int]] = []
        for row, ids in zip(rows, singly([name.join([*row, ""]) for row in rows])):
            if ids.count(number) != len(row):
                found += singly(row)
                continue
            at = 0
            for _ in row:
                to = ids.index(number, at)
                found.append(ids[at:to])
                at = to + 1
        return found

    return encode


def load_tokenizer(path: str, end: int = END) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Function from texts to their ids in a row, each text's end id included, and the number of each; one per worker process."""
    if (path, end) not in _coders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        own, words = Tokenizer.from_file(path), drops_white_space(path)
        coder = Coder(joint_encoder(own, mark_of(own) if words else None), end)
        table = to_spaces(b" \t\n\r")
        added = [t.content.encode().lower() for t in own.get_added_tokens_decoder().values()]

        def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            if words:
                # The tokenizer lower-cases all but its added tokens: capitals need not make words distinct.
                low = byte_array(texts)[0].tobytes().lower()
                found = Words(texts, table if any(a in low for a in added) else table.lower(), points=True)
                return coder.ids(found.values, found.text, len(texts))
            return coder.ids(texts.cast(pa.large_binary()).fill_null(b""), np.arange(len(texts)), len(texts))

        _coders[path, end] = run
    return _coders[path, end]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    return control, values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]


def decode(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The `n` values of control bytes and data bytes."""
    sizes = BYTES[control].ravel()[:n]
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    values = data[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(sizes > k)
        if not len(longer):
            break
        values[longer] |= data[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def tokenised(docs: DataFrame, load: Callable) -> DataFrame:
    """Ids of every document, and one more row per partition with its counts of ids; written once."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        code, part, row, counts = load(), TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)
        for batch in steps(batches, "text"):
            ids, lengths = code(batch["text"])
            found = np.bincount(ids, minlength=len(counts))
            found[: len(counts)] += counts
            counts, n = found, len(lengths)
            wide = len(counts) > 1 << 16
            kept = ids.astype("<u4" if wide else "<u2")
            yield {
                "doc_id": batch["doc_id"],
                "part": np.full(n, part),
                "row": np.arange(row, row + n),
                "n": lengths,
                "wide": np.full(n, wide),
                "ids": binary(kept, kept.itemsize * np.append(0, np.cumsum(lengths))),
                "counts": pa.nulls(n, pa.binary()),
            }
            row += n
        yield {"doc_id": [None], "part": [part], "row": [-1], "n": [0], "wide": [False], "ids": [None], "counts": [counts.astype("<i8").tobytes()]}

    return stored(map_batches(docs.select("doc_id", "text"), TOKENISED, run), "tokenised")


def ranked(tokens: DataFrame) -> DataFrame:
    """(rank, id, n) of the ids that occur: sums of the partitions' counts."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counts in batch["counts"]:
                counts = np.frombuffer(counts.as_buffer(), "<i8")
                held = np.zeros(max(len(total), len(counts)), np.int64)
                held[: len(total)] += total
                held[: len(counts)] += counts
                total = held
        at = np.flatnonzero(total)
        yield {"id": at, "n": total[at]}

    sums = map_batches(tokens.where("counts is not null").select("counts"), "id long, n long", run).groupBy("id").agg(F.sum("n").alias("n"))
    # One row per entry of the vocabulary: a window over them all is small.
    return sums.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).cast("long").alias("rank"), "id", "n")


def order_of(ranks: DataFrame) -> np.ndarray:
    rows = ranks.select("rank", "id").toArrow().to_pydict()
    order = np.zeros(len(rows["id"]), np.int64)
    order[rows["rank"]] = rows["id"]
    return order


def write(docs: DataFrame, load: Callable, folder: str, file_ids: int = FILE) -> None:
    """Writes the ids of `docs` (doc_id, text) to `folder`; `load()` gives the encoder of texts in a worker."""
    spark = docs.sparkSession
    tokens = tokenised(docs, load)
    ranked(tokens).coalesce(1).write.parquet(f"{folder}/ranks")
    order = order_of(spark.read.parquet(f"{folder}/ranks"))
    places = np.zeros(int(order.max(initial=-1)) + 1, np.uint32)
    places[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(places)
    total = tokens.agg(F.sum("n")).first()[0] or 0
    files = max(1, -(-total // file_ids), min(-(-total // LEAST), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def blocks(batches: Iterator[dict]) -> Iterator[dict]:
        file, block, first, ranks = TaskContext.get().partitionId(), 0, 0, shared.value
        keys: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        values: list[np.ndarray] = []
        held = 0

        def row() -> dict:
            ids = pa.concat_arrays(keys)
            control, data = encode(np.concatenate(values))
            fields = {"file": file, "block": block, "first": first, "n_ids": held, "n_docs": len(ids), "no_id": ids.null_count}
            known = ids.drop_null().to_numpy().astype("<i8").tobytes()
            fields |= {"doc_ids": known, "lengths": np.concatenate(lengths).astype("<i8").tobytes()}
            fields |= {"control": control.tobytes(), "data": data.tobytes()}
            return {k: [v] for k, v in fields.items()}

        for batch in batches:
            n, wide = batch["n"].to_numpy(), batch["wide"].to_numpy(zero_copy_only=False)
            data, ends = byte_array(batch["ids"])
            at = 0
            while at < len(n):
                # Documents up to the one that fills the block.
                to = min(at + 1 + int(np.searchsorted(np.cumsum(n[at:]), BLOCK - held)), len(n))
                part = [
                    np.frombuffer(data[ends[i] : ends[j]].tobytes(), "<u4" if wide[i] else "<u2")
                    for i, j in _runs(wide, at, to)
                ]
                values += [ranks[p] for p in part]
                keys.append(batch["doc_id"].slice(at, to - at))
                lengths.append(n[at:to])
                held += int(n[at:to].sum())
                at = to
                if held >= BLOCK:
                    yield row()
                    block, first, held = block + 1, first + held, 0
                    keys, lengths, values = [], [], []
        if keys:
            yield row()

    by = ["doc_id", "part", "row"]
    dealt = tokens.where("counts is null").drop("counts").repartitionByRange(files, *by).sortWithinPartitions(*by)
    map_batches(dealt, BLOCKS, blocks).write.option("compression", "none").parquet(f"{folder}/blocks")


def _runs(flags: np.ndarray, start: int, end: int) -> list[tuple[int, int]]:
    """Stretches of equal flags from start to end."""
    cuts = np.flatnonzero(flags[start + 1 : end] != flags[start : end - 1]) + start + 1
    edges = [start, *cuts.tolist(), end]
    return list(zip(edges[:-1], edges[1:]))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian, 32 bits) of every document of a folder."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    shared = spark.sparkContext.broadcast(order_of(spark.read.parquet(f"{folder}/ranks")).astype("<u4"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.groupBy("file").agg(F.sum("n_ids").alias("total"))
    bases = bases.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        order = shared.value
        for batch in batches:
            plain = [batch[c].to_pylist() for c in ("start", "n_ids", "no_id")]
            for i, (start, n, no_id) in enumerate(zip(*plain)):
                part = {c: np.frombuffer(batch[c][i].as_buffer(), t) for c, t in _FIELDS.items()}
                ids = order[decode(part["control"], part["data"], n)]
                ends = np.append(0, np.cumsum(part["lengths"]))
                yield {
                    "doc_id": pa.concat_arrays([pa.nulls(no_id, pa.int64()), pa.array(part["doc_ids"], pa.int64())]),
                    "start": start + ends[:-1],
                    "n_tokens": part["lengths"],
                    "ids": binary(ids, 4 * ends),
                }

    # One row of 16 bytes per file.
    placed = blocks.join(F.broadcast(bases), "file").withColumn("start", F.col("base") + F.col("first"))
    return map_batches(placed.select("start", "n_ids", "no_id", *_FIELDS), READ, run)


_FIELDS = {"doc_ids": "<i8", "lengths": "<i8", "control": np.uint8, "data": np.uint8}


def round_trip(docs: DataFrame, load: Callable) -> DataFrame:
    """`docs` written to a folder of the shared scratch space and read back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write(docs, load, folder)
    return read(docs.sparkSession, folder)
