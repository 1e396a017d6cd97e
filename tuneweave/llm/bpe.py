"""Byte-level BPE: encoding by ranks and decoding.

Two-tier lookup. A pre-token that is a vocabulary entry is resolved by a minimal
perfect hash over the entries: as every entry can be reached by merges, its own
rank is its encoding. All other pre-tokens are merged with a heap of candidate
pairs over a linked list of their bytes. What a pre-token encodes to is
remembered per worker process, in caches of bounded size. The hash is built once on the
driver and broadcast. With a pattern by which a space belongs to what follows it, each
distinct chunk between spaces is encoded once.

Defined results: a null or empty text has no ids and decodes to nothing; null
ids decode to nothing; an id outside the vocabulary is an error; repeated rows
and other columns do not matter.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneweave.llm.common import map_batches
from tuneweave.llm.vectors import Coder, space_chunks, steps

CACHE = 200_000
# Pattern by which a text is the chain of its chunks before spaces (fixed value).
SPACE_FIRST = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_loaded: dict[tuple[str, str], Codec] = {}


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    with open(path, "rb") as lines:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in lines if line.strip())]


class PerfectHash:
    """Minimal perfect hash of byte strings to 0..n-1 by displacement (compress, hash and displace).

    A first hash deals the keys to n / 3 groups. From the largest group down, the
    smallest displacement is taken that sends all keys of a group to free slots.
    """

    def __init__(self, keys: list[bytes]):
        import xxhash

        self._hash = xxhash.xxh3_64_intdigest
        self.size = max(1, len(keys))
        self.groups = max(1, (len(keys) + 2) // 3)
        dealt: list[list[int]] = [[] for _ in range(self.groups)]
        digests = [self._hash(k) for k in keys]
        for i, digest in enumerate(digests):
            dealt[(digest >> 40) % self.groups].append(i)
        self.displacement = [0] * self.groups
        free = bytearray(b"\x01") * self.size
        self.index = [-1] * self.size
        for group in sorted(range(self.groups), key=lambda g: -len(dealt[g])):
            members, d = dealt[group], 0
            if not members:
                break
            while True:
                slots = {self._slot(digests[i], d) for i in members}
                if len(slots) == len(members) and all(free[s] for s in slots):
                    break
                d += 1
            self.displacement[group] = d
            for i in members:
                slot = self._slot(digests[i], d)
                free[slot], self.index[slot] = 0, i

    @classmethod
    def restored(cls, size: int, groups: int, displacement: list[int], index: list[int]) -> PerfectHash:
        import xxhash

        own = cls.__new__(cls)
        own._hash, own.size, own.groups, own.displacement, own.index = xxhash.xxh3_64_intdigest, size, groups, displacement, index
        return own

    def _slot(self, digest: int, d: int) -> int:
        mixed = ((digest & 0xFFFFFFFFFF) ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        return (mixed >> 20) % self.size

    def find(self, key: bytes) -> int:
        """Position of the key that shares this key's slot; the caller compares the two."""
        digest = self._hash(key)
        return self.index[self._slot(digest, self.displacement[(digest >> 40) % self.groups])]


class Codec:
    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str):
        self.entries = [k for k, _ in ranks]
        self.ranks = [v for _, v in ranks]
        self.pattern = pattern
        self.hash = PerfectHash(self.entries)
        self.prepare()

    def __getstate__(self) -> tuple:
        h = self.hash
        return self.entries, np.array(self.ranks), self.pattern, h.size, h.groups, np.array(h.displacement), np.array(h.index)

    def __setstate__(self, state: tuple) -> None:
        self.entries, ranks, self.pattern, size, groups, displacement, index = state
        self.ranks = ranks.tolist()
        self.hash = PerfectHash.restored(size, groups, displacement.tolist(), index.tolist())
        self.prepare()

    def prepare(self) -> None:
        import regex

        self.split = regex.compile(self.pattern).findall
        self.cache: dict[str, list[int]] = {}
        self.pairs: dict[bytes, int] = {}
        self.single = [self.rank(bytes([b])) for b in range(256)]
        self.coder = Coder(self.encode_chunks)
        order = dict(zip(self.ranks, self.entries))
        top = max(order, default=-1) + 1
        self.known = np.array([i in order for i in range(top)], dtype=bool)
        self.pieces = np.array([order.get(i, b"") for i in range(top)] + [None], dtype=object)[:-1]
        self.decimals = np.array([str(i).encode() for i in range(top)] + [None], dtype=object)[:-1]

    def rank(self, piece: bytes) -> int | None:
        at = self.hash.find(piece)
        return self.ranks[at] if at >= 0 and self.entries[at] == piece else None

    def pair_rank(self, piece: bytes) -> int:
        """Rank of two parts joined, -1 without one; short ones are asked for so often that they are remembered."""
        found = self.rank(piece)
        found = -1 if found is None else found
        if len(piece) <= 12:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            self.pairs[piece] = found
        return found

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no entry: the lowest-ranked adjacent pair is merged first, the leftmost of equals."""
        n, known, look = len(piece), self.pairs.get, self.pair_rank
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        ends = list(range(1, n + 1))
        ids = [self.single[b] for b in piece]
        heap: list[tuple[int, int, int, int]] = []
        for i in range(n - 1):
            part = piece[i : i + 2]
            rank = known(part)
            if rank is None:
                rank = look(part)
            if rank >= 0:
                heap.append((rank, i, i + 1, i + 2))
        heapq.heapify(heap)
        while heap:
            rank, left, middle, end = heapq.heappop(heap)
            right = after[left] if ends[left] == middle else n
            if right >= n or ends[right] != end:
                continue  # one of the two has been merged since
            ends[left], ends[right], ids[left] = end, -1, rank
            right = after[left] = after[right]
            # The merged part now makes a pair with the part after it and with the one before.
            if right < n:
                before[right] = left
                part = piece[left : ends[right]]
                rank = known(part)
                if rank is None:
                    rank = look(part)
                if rank >= 0:
                    heapq.heappush(heap, (rank, left, end, ends[right]))
            first = before[left]
            if first >= 0:
                part = piece[first:end]
                rank = known(part)
                if rank is None:
                    rank = look(part)
                if rank >= 0:
                    heapq.heappush(heap, (rank, first, left, end))
        found, at = [], 0
        while at < n:
            if ids[at] is None:
                raise ValueError(f"the vocabulary has no entry for the byte {piece[at:ends[at]]!r}")
            found.append(ids[at])
            at = after[at]
        return found

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        """Ids of each chunk: its pre-tokens one by one."""
        cache, found = self.cache, []
        for chunk in chunks:
            ids: list[int] = []
            for p in self.split(chunk.decode("utf-8")):
                own = cache.get(p)
                if own is None:
                    raw = p.encode("utf-8")
                    whole = self.rank(raw)
                    own = [whole] if whole is not None else self.merge(raw)
                    if len(p) <= 64:
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[p] = own
                ids += own
            found.append(ids)
        return found

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        n = len(texts)
        if self.pattern == SPACE_FIRST:
            return self.coder.ids(*space_chunks(texts), n)
        return self.coder.ids(texts.cast(pa.large_binary()).fill_null(b""), np.arange(n), n)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encode_chunks([text.encode("utf-8")])[0], dtype=np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, dtype=np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is outside the vocabulary")
        return b"".join(self.pieces[ids].tolist())


def codec(path: str, pattern: str) -> Codec:
    """The codec of this process, which is the driver's or, once `shared` has sent it, a worker's."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Codec(read_ranks(path), pattern)
    return _loaded[path, pattern]


def shared(path: str, pattern: str) -> Callable[[], Codec]:
    """Function that gives the codec in a worker: built here and broadcast, kept there between tasks."""
    sent = SparkSession.active().sparkContext.broadcast(codec(path, pattern))

    def get() -> Codec:
        if (path, pattern) not in _loaded:
            _loaded[path, pattern] = sent.value
        return _loaded[path, pattern]

    return get


def encode(path: str, pattern: str) -> Callable[[Column], Column]:
    """Column function: text to array of ids, by a rank file that the driver can open."""
    own = shared(path, pattern)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found, lengths = own().encode_texts(pa.array(texts, pa.string()))
            yield pd.Series(np.split(found.astype(np.int32), np.cumsum(lengths)[:-1]) if len(lengths) else [], dtype=object)

    return ids


def decode(path: str, pattern: str) -> Callable[[Column], Column]:
    """Column function: array of ids to bytes."""
    own = shared(path, pattern)

    @F.pandas_udf("binary")
    def data(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([own().decode(r) if r is not None else b"" for r in rows], dtype=object)

    return data


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of each text's ids (decimal, joined by commas) and of what these decode to; no id leaves the worker."""
    own = shared(path, pattern)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in steps(batches, "text"):
            ids, lengths = own().encode_texts(batch["text"])
            ends = np.append(0, np.cumsum(lengths)).tolist()
            numbers = own().decimals[ids].tolist()
            yield {
                "doc_id": batch["doc_id"],
                "n_tokens": lengths,
                "ids_sha256": [sha256(b",".join(numbers[i:j])).hexdigest() for i, j in zip(ends[:-1], ends[1:])],
                "decoded_sha256": [sha256(own().decode(ids[i:j])).hexdigest() for i, j in zip(ends[:-1], ends[1:])],
            }

    return map_batches(docs.select("doc_id", "text"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", run)
