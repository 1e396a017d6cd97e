"""Texts as byte arrays: cutting, hashing and gathering whole batches of texts at a time with numpy and Arrow."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

# Bytes of text that one vectorised step takes; a longer text is a step of its own.
STEP = 2 << 20
# Bytes of ids and chunks that a worker remembers.
CACHE = 64 << 20
SPACE = 0x20


def byte_array(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values in a row, and where each value starts, with the end; a null is empty."""
    values = values.cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    n = len(values)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64, n + 1, 8 * values.offset)
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
    return held, ends - ends[0]


def binary(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Array of the stretches of `data` between neighbouring offsets (in bytes)."""
    data = np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(
        kind or pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]
    )


def steps(batches: Iterator[dict], key: str, size: int = STEP) -> Iterator[dict]:
    """The batches cut and merged to about `size` bytes of the text column `key`, rows in order."""
    held: list[dict] = []
    total = 0

    def merged() -> dict:
        if len(held) == 1:
            return held[0]
        return {k: pa.concat_arrays([h[k] for h in held]) for k in held[0]}

    for batch in batches:
        at, n = 0, len(batch[key])
        if not n:
            continue
        ends = byte_array(batch[key])[1]
        while at < n:
            to = int(np.searchsorted(ends, ends[at] + size - total, "left"))
            to = min(max(to, at + 1), n)
            held.append({k: v.slice(at, to - at) for k, v in batch.items()})
            total += int(ends[to] - ends[at])
            at = to
            if total >= size:
                yield merged()
                held, total = [], 0
    if held:
        yield merged()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the stretches (start, length), one stretch after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


_letter = np.array([i < 128 and chr(i).isalpha() for i in range(256)])
_point = np.array([chr(i) in ".,;:!?" for i in range(256)])
# Second bytes of U+00C0 to U+00FF without the signs for multiplication and division.
_latin = np.array([0x80 <= i < 0xC0 and i not in (0x97, 0xB7) for i in range(256)])


def after_letters(data: np.ndarray) -> np.ndarray:
    """Which bytes are points, commas and the like right after a letter of Latin-1: there the usual patterns always cut."""
    marks = _point[data]
    at = np.flatnonzero(marks)
    before, earlier = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    marks[at] = (at > 0) & (_letter[before] | (at > 1) & _latin[before] & (earlier == 0xC3))
    return marks


class Words:
    """Words of many texts: maximal stretches of bytes that `table` does not map to a separator.

    `table` maps each byte to the byte that words are compared by. Bytes mapped to a space separate
    words, those mapped to `cut` separate pieces as well. With `points`, points after a letter begin a word too.
    """

    def __init__(self, values: pa.Array, table: bytes, cut: int | None = None, points: bool = False):
        data, ends = byte_array(values)
        data = np.frombuffer(data.tobytes().translate(table), np.uint8)
        inside = data != SPACE
        if cut is not None:
            inside &= data != cut
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = ends[:-1][ends[:-1] < ends[1:]]
        first[begins] = inside[begins]
        if points:
            first |= after_letters(data)
        starts = np.flatnonzero(first)
        self.text = np.searchsorted(ends, starts, "right") - 1
        # Bytes of words in a row: the place of a start among them ends the word before.
        kept = np.cumsum(inside) if len(inside) else np.zeros(0, np.int64)
        bounds = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0)
        self.lengths = np.diff(bounds)
        self.values = binary(data[inside], bounds)
        self.count = len(starts)
        self.piece = self.text + (np.cumsum(data == cut)[starts] if cut is not None else 0)


def to_spaces(characters: bytes) -> bytes:
    """Table for `Words` that separates words at `characters` and changes nothing else."""
    return bytes(SPACE if i in characters else i for i in range(256))


_blank = np.array([i in b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f " or i >= 128 for i in range(256)])
# White space, then a space, then white space or the end.
_long_space = re.compile(r"\s (?!\S)").search


def space_chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Chunks that begin with a space, a point after a letter or their text, and the text of each.

    For patterns by which a space belongs to what follows it, unless it stands between other
    white space: texts with such a space are one chunk, whole.
    """
    data, ends = byte_array(texts)
    spaces = np.flatnonzero(data == SPACE)
    owner = np.searchsorted(ends, spaces, "right") - 1
    begun = spaces > ends[owner]
    before = begun & _blank[data[spaces - begun]]
    last = spaces + 1 >= ends[owner + 1]
    after = last | _blank[data[np.minimum(spaces + 1, max(len(data) - 1, 0))]]
    whole = np.zeros(len(ends) - 1, bool)
    for t in np.unique(owner[before & after]):
        whole[t] = _long_space(data[ends[t] : ends[t + 1]].tobytes().decode("utf-8", "replace")) is not None
    points = np.flatnonzero(after_letters(data))
    points = points[~whole[np.searchsorted(ends, points, "right") - 1]]
    first = np.zeros(len(data), bool)
    for at in (spaces[~whole[owner]], points, ends[:-1][ends[:-1] < ends[1:]]):
        first[at] = True
    starts = np.flatnonzero(first)
    return binary(data, np.append(starts, len(data))), np.searchsorted(ends, starts, "right") - 1


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """`array`, made at least twice as long if it holds fewer than `size` values."""
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array)), array.dtype)])


class Coder:
    """Ids of texts as the chain of the ids of their chunks, each distinct chunk encoded once.

    `encode` gives the ids of a list of chunks; `end` is put after each text. What is
    remembered is bounded in bytes; beyond that only chunks asked for by several steps are kept.
    """

    def __init__(self, encode: Callable[[list[bytes]], list], end: int | None = None, kind=np.uint32):
        self.encode, self.end, self.kind = encode, end, kind
        # Slot of each chunk, in ascending order; by slot: where its ids start, how many they are, steps that asked for it.
        self.known: dict[bytes, int] = {}
        self.flat = np.empty(0, kind)
        self.starts, self.sizes, self.hits = (np.zeros(0, np.int64) for _ in range(3))
        self.used, self.memory = 0, 0

    def forget(self) -> None:
        """Forgets the chunks that one step alone asked for, and of the others the least used beyond half of CACHE."""
        listed, self.known = list(self.known), {}
        n = len(listed)
        bytes_of = np.fromiter(map(len, listed), np.int64, n) + self.sizes[:n] * self.flat.itemsize + 150
        kept = np.argsort(-self.hits[:n], kind="stable")[: np.count_nonzero(self.hits[:n] > 1)]
        kept = kept[np.cumsum(bytes_of[kept]) <= CACHE // 2]
        sizes = self.sizes[kept]
        self.flat = self.flat[ranges(self.starts[kept], sizes)]
        self.starts, self.sizes, self.hits = np.cumsum(sizes) - sizes, sizes, np.zeros(len(kept), np.int64)
        self.known = {listed[i]: slot for slot, i in enumerate(kept.tolist())}
        self.used, self.memory = len(self.flat), int(bytes_of[kept].sum())

    def learn(self, chunks: list[bytes]) -> np.ndarray:
        """Slots of chunks that are not known yet, each named once."""
        found = self.encode(chunks)
        first, n = len(self.known), len(chunks)
        sizes = np.fromiter(map(len, found), np.int64, n)
        ends = self.used + np.cumsum(sizes)
        used = int(ends[-1])
        self.flat = _room(self.flat, used)
        self.starts, self.sizes, self.hits = (_room(a, first + n) for a in (self.starts, self.sizes, self.hits))
        self.flat[self.used : used] = np.fromiter(chain.from_iterable(found), self.kind, used - self.used)
        self.starts[first : first + n], self.sizes[first : first + n] = ends - sizes, sizes
        self.known.update(zip(chunks, range(first, first + n)))
        self.memory += sum(map(len, chunks)) + (used - self.used) * self.flat.itemsize + 150 * n
        self.used = used
        return np.arange(first, first + n)

    def slots(self, chunks: pa.Array) -> np.ndarray:
        if self.memory > CACHE:
            self.forget()
        coded = chunks.dictionary_encode()
        listed = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        table = np.fromiter(map(self.known.get, listed, repeat(-1)), np.int64, len(listed))
        fresh = np.flatnonzero(table < 0)
        if len(fresh):
            table[fresh] = self.learn([listed[i] for i in fresh.tolist()])
        self.hits[table] += 1
        return table[coded.indices.to_numpy(zero_copy_only=False)]

    def ids(self, chunks: pa.Array, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all `n` texts in a row and how many each has; `text` is the text of each chunk, ascending."""
        slots = self.slots(chunks)
        sizes = self.sizes[slots]
        ids = self.flat[ranges(self.starts[slots], sizes)]
        lengths = np.bincount(text, sizes, n).astype(np.int64) if n else np.zeros(0, np.int64)
        if self.end is not None:
            ids = np.insert(ids, np.cumsum(lengths), self.kind(self.end))
            lengths = lengths + 1
        return ids, lengths
