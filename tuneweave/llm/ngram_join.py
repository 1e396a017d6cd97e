"""Self-join of texts by the Jaccard similarity of their word shingles, with signature trees.

1. One pass over the texts gives each document the size and fingerprint of its
   shingle set, and the shingles that make up at least 1/2^16 of all. Documents
   with equal sets are one class from here on.
2. Classes are routed by shingles. In one order of all shingles (frequent ones
   last, then long ones first), two sets that link share one of their first
   n - ceil(t * n) + 1 shingles. Long shingles are rare, so most routes lead nowhere.
   Classes that meet, sorted by size, are cut into blocks of 256 on average and 1,024 at most.
3. In each block a signature tree is built: its nodes hold the OR of the token
   bitmaps below them and the range of set sizes. Two trees (or one and itself)
   are walked together; a pair of nodes is dropped when its largest possible
   overlap is too small for a link, or when all below it is one component already.
   This first runs on bitmaps alone; classes that are left without a partner drop out.
4. The classes that remain are compared exactly, walking the trees again. First each class
   meets those that share its largest block with it, which joins large groups of near copies; pairs
   that met are settled. Then all blocks, and pairs of blocks of one shingle, with a pair that is still open
   between components are compared. Pairs stay inside their task: only links that join components leave it.

Shingles are compared by 64-bit hashes and sets by 128-bit hashes. No block,
partner or candidate is capped.

Defined results: null texts and texts without words have an empty set and are a
component of their own; a null doc_id takes no part and is its own, null
component; rows with equal ids keep their own set size and the id joins their
components only through the rows themselves; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneweave.llm.common import map_batches
from tuneweave.llm.components import components
from tuneweave.session import stored

WORDS = 5
PERCENT = 80
FREQUENT = 2.0**-16
BLOCK, LONGEST_BLOCK = 256, 1024
FANOUT = 8
WIDEST = 1 << 15  # bits of a bitmap; the bound stays valid for larger sets
ROUNDS = 2
PAIRS = 1 << 15  # node pairs compared at a time
GROUP = 1 << 20  # shingles counted at a time


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles of `size` words, and their lengths in bytes; a shorter text is one shingle."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    h = np.full(count, size, np.uint64)
    span = np.zeros(count, np.int64)
    for k in range(size):
        h = mix(h) + hashes[k : k + count]
        span += lengths[k : k + count]
    distinct, at = np.unique(mix(h), return_index=True)
    return distinct, span[at]


def fingerprint(hashes: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(hashes.tobytes())


def profile(docs: DataFrame, size: int, share: float) -> DataFrame:
    """Written once: (doc_id, fp, n) of every row; and (token, times) of shingles frequent in a group of texts."""

    def tally(held: list[np.ndarray]) -> dict:
        tokens, times = np.unique(np.concatenate(held), return_counts=True)
        often = times >= max(2, int(sum(map(len, held)) * share / 2))
        return {"token": tokens[often].view(np.int64), "times": times[often]}

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held, count = [], 0
        blank = lambda n, kind: pa.nulls(n, kind)
        for batch in batches:
            prints, sizes = [], []
            out = []
            for value in batch["text"]:
                tokens = shingles(value.as_py(), size)[0]
                prints.append(fingerprint(tokens) if len(tokens) else None)
                sizes.append(len(tokens))
                held.append(tokens)
                count += len(tokens)
                if count >= GROUP:
                    out.append(tally(held))
                    held, count = [], 0
            n = len(sizes)
            yield {"doc_id": batch["doc_id"], "fp": prints, "n": sizes, "token": blank(n, pa.int64()), "times": blank(n, pa.int64())}
            for o in out:
                yield often_rows(o)
        if count:
            yield often_rows(tally(held))

    def often_rows(o: dict) -> dict:
        n = len(o["token"])
        return {"doc_id": pa.nulls(n, pa.int64()), "fp": pa.nulls(n, pa.binary()), "n": pa.nulls(n, pa.int64()), **o}

    schema = "doc_id long, fp binary, n long, token long, times long"
    return stored(map_batches(docs.select("doc_id", "text"), schema, run), "profile")


def frequent_tokens(profiles: DataFrame, share: float) -> np.ndarray:
    """Sorted shingles with at least `share` of all shingles of the corpus: at most 1 / share of them."""
    total = profiles.agg(F.sum("n")).first()[0] or 0
    sums = profiles.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    rows = sums.where(F.col("times") >= max(2.0, total * share)).select("token").collect()
    return np.sort(np.array([r["token"] for r in rows], dtype=np.int64).view(np.uint64))


def route_tokens(tokens: np.ndarray, spans: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set in the order all sets share; a linked set has one of them among its own first."""
    n = len(tokens)
    count = n - -(-percent * n // 100) + 1
    if len(often):
        at = np.searchsorted(often, tokens)
        common = often[np.minimum(at, len(often) - 1)] == tokens
    else:
        common = np.zeros(n, bool)
    return tokens[np.lexsort((tokens, -spans, common))[:count]]


def routes(docs: DataFrame, size: int, percent: int, often: np.ndarray) -> DataFrame:
    """Written once: (fp, n, map, keys). Classes repeat at most once per input partition."""
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        seen: set[bytes] = set()
        for batch in batches:
            prints, sizes, maps, keys = [], [], [], []
            for value in batch["text"]:
                tokens, spans = shingles(value.as_py(), size)
                if len(tokens) and (fp := fingerprint(tokens)) not in seen:
                    seen.add(fp)
                    prints.append(fp)
                    sizes.append(len(tokens))
                    maps.append(signature(tokens))
                    keys.append(route_tokens(tokens, spans, shared.value, percent).view(np.int64))
            yield {"fp": prints, "n": sizes, "map": maps, "keys": keys}

    schema = "fp binary, n long, map binary, keys array<long>"
    return stored(map_batches(docs.where("doc_id is not null").select("text"), schema, run), "routes")


class Blocks:
    """Cuts runs of equal keys, sorted by key, size and class, into blocks of classes."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.key: int | None = None
        self.first = True
        self.members: list[tuple[int, bytes]] = []
        self.cut = False
        self.out: dict[str, list] = {"key": [], "id": [], "fps": [], "low": [], "high": [], "part": []}

    def emit(self, part: bool) -> None:
        from xxhash import xxh3_128_digest

        fps = [fp for _, fp in self.members]
        if not part and len(fps) > 1:
            # Sizes are sorted: who fits neither neighbour fits nobody in a block that stands alone.
            fits = [100 * a >= self.percent * b for (a, _), (b, _) in zip(self.members, self.members[1:])]
            fps = [fp for fp, before, after in zip(fps, [False, *fits], [*fits, False]) if before or after]
        if len(fps) > 1 or part and fps and not self.cut:
            self.out["key"].append(self.key)
            self.out["id"].append(xxh3_128_digest(b"".join(fps)))
            self.out["fps"].append(fps)
            self.out["low"].append(self.members[0][0])
            self.out["high"].append(self.members[-1][0])
            self.out["part"].append(part)

    def start(self, key: int, edge: bool = False) -> None:
        """End the current run; `edge`: it may go on in the next partition."""
        if self.key is not None:
            self.emit(self.cut or self.first or edge)
            self.first = False
        self.key, self.members, self.cut = key, [], False

    def add(self, n: int, fp: bytes) -> None:
        if self.members and self.members[-1][1] == fp:
            return
        self.members.append((n, fp))
        if len(self.members) > 1 and fp[0] == 0 or len(self.members) >= LONGEST_BLOCK:
            self.emit(True)
            # The last member also begins the next block, so that a group's blocks hang together.
            self.members, self.cut = self.members[-1:], True

    def take(self) -> dict[str, list]:
        out, self.out = self.out, {k: [] for k in self.out}
        return out


def blocked(routed: DataFrame, percent: int) -> DataFrame:
    """Written once: blocks (key, id, fps, low, high, part) of classes that meet; `part`: the key may have other blocks.

    Rows are dealt by ranges of (key, size, class), so a key with very many classes goes to several tasks.
    """
    rows = routed.select(F.explode("keys").alias("key"), "n", "fp")
    rows = rows.repartitionByRange("key", "n", "fp").sortWithinPartitions("key", "n", "fp")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        own = Blocks(percent)
        for batch in batches:
            keys = batch["key"].to_numpy()
            if not len(keys):
                continue
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[starts[1:], len(keys)]
            wanted = ends - starts > 1
            wanted[[0, -1]] = True  # runs that may go on in a neighbouring batch or partition
            for a, b in zip(starts[wanted].tolist(), ends[wanted].tolist()):
                if own.key != keys[a]:
                    own.start(int(keys[a]))
                sizes, fps = batch["n"].slice(a, b - a).to_pylist(), batch["fp"].slice(a, b - a).to_pylist()
                for n, fp in zip(sizes, fps):
                    own.add(n, fp)
            yield own.take()
        own.start(0, edge=True)
        yield own.take()

    schema = "key long, id binary, fps array<binary>, low long, high long, part boolean"
    return stored(map_batches(rows, schema, run), "blocks")


def signature(tokens: np.ndarray) -> bytes:
    """Bitmap of a set: a bit or more for each token, a power of two, at most WIDEST."""
    bits = min(WIDEST, max(64, 1 << int(len(tokens) - 1).bit_length()))
    filled = np.zeros(bits, bool)
    filled[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(filled).tobytes()


class Tree:
    """Levels of nodes over sets sorted by size, the sets first; each has bitmap, size range, largest excess, component
    and period: the bytes after which its bitmap repeats, as shorter bitmaps are repeated to one width."""

    def __init__(self, maps: list[bytes], sizes: list[int], labels: np.ndarray, width: int):
        own = [np.frombuffer(m, np.uint8) for m in maps]
        # Repeating a shorter bitmap sets every bit that its tokens may have in a longer one.
        level = np.stack([np.tile(m, width // len(m)) for m in own]).view(np.uint64)
        low = np.array(sizes, dtype=np.int64)
        # Tokens that share a bit with another token of the same set.
        excess = low - np.array([int(np.bitwise_count(m).sum()) for m in own], dtype=np.int64)
        period = np.array([len(m) for m in own], dtype=np.int64)
        self.levels = [(level, low, low, excess, labels, period)]
        while len(self.levels[-1][1]) > 1:
            level, low, high, excess, labels, period = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            lowest, highest = np.minimum.reduceat(labels, at), np.maximum.reduceat(labels, at)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(level, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(excess, at),
                    np.where(lowest == highest, lowest, -1),
                    np.maximum.reduceat(period, at),
                )
            )


def may_link(left: tuple, i: np.ndarray, right: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets below nodes i and j can link: by the largest overlap that sizes and bitmaps allow."""
    maps_a, low_a, high_a, excess_a, label_a, period_a = left
    maps_b, low_b, high_b, excess_b, label_b, period_b = right
    width = maps_a.shape[1] * maps_a.itemsize
    least = low_a[i] + low_b[j]
    most = np.minimum(high_a[i], high_b[j])
    open_ = ((100 + percent) * most >= percent * least) & ((label_a[i] < 0) | (label_a[i] != label_b[j]))
    open_ &= (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i])
    some = np.flatnonzero(open_)
    for start in range(0, len(some), PAIRS):
        at = some[start : start + PAIRS]
        both = np.bitwise_count(maps_a[i[at]] & maps_b[j[at]]).sum(axis=1).astype(np.int64)
        # Counted once, not in each repetition.
        both //= width // np.maximum(period_a[i[at]], period_b[j[at]])
        best = np.minimum(most[at], both + np.minimum(excess_a[i[at]], excess_b[j[at]]))
        open_[at] = (100 + percent) * best >= percent * least[at]
    return open_


def walk(left: Tree, right: Tree, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets that no node pair above them has ruled out; with `same`, each pair once."""
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    a, b = len(left.levels) - 1, len(right.levels) - 1
    while True:
        keep = may_link(left.levels[a], i, right.levels[b], j, percent)
        if same and a == 0:
            keep &= i < j
        i, j = i[keep], j[keep]
        if a == 0 and b == 0 or not len(i):
            return i, j
        down_a, down_b = a > 0 and (same or a >= b), b > 0 and (same or b >= a)
        for side in (0, 1):
            if (down_a, down_b)[side]:
                level = (left.levels[a - 1], right.levels[b - 1])[side]
                own = (i, j)[side][:, None] * FANOUT + np.arange(FANOUT)
                valid = own < len(level[1])
                other = np.broadcast_to((j, i)[side][:, None], own.shape)[valid]
                own = own[valid]
                i, j = (own, other) if side == 0 else (other, own)
        a, b = a - down_a, b - down_b
        if same:
            keep = i <= j
            i, j = i[keep], j[keep]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def open_pairs(groups: list[list[tuple]], percent: int, homes: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of members that may link, and the labels; members are (fp, label, n, map, ...), of one group or of two.

    Homes are, for each member, the groups in which its class met all others at home there, round by round: pairs that
    share one are settled.
    """
    members = [m for g in groups for m in g]
    number: dict[bytes, int] = {}
    labels = np.array([number.setdefault(m[1], len(number)) for m in members], dtype=np.int64)
    width = max(len(m[3]) for m in members)
    trees, at = [], 0
    for g in groups:
        trees.append(Tree([m[3] for m in g], [m[2] for m in g], labels[at : at + len(g)], width))
        at += len(g)
    i, j = walk(trees[0], trees[-1], len(groups) == 1, percent)
    j = j + (len(groups[0]) if len(groups) > 1 else 0)
    for met in zip(*(h or () for h in homes or ())):
        seen: dict[bytes, int] = {}
        home = np.array([seen.setdefault(h, len(seen)) for h in met], dtype=np.int64)
        apart = home[i] != home[j]
        i, j = i[apart], j[apart]
    return i, j, labels


def links_within(groups: list[list[tuple]], percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Links that join the components of one block, or of the two given blocks: a forest, found exactly.

    Members are (fp, label, n, map, homes, hashes), sorted by size.
    """
    members = [m for g in groups for m in g]
    i, j, labels = open_pairs(groups, percent, [m[4] for m in members])
    order = np.lexsort((j, i))
    i, j = i[order], j[order]
    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]).tolist() if len(i) else []
    for start, end in zip(starts, [*starts[1:], len(i)]):
        one = int(i[start])
        others = j[start:end]
        for other in others[labels[others] != labels[one]].tolist():
            if labels[other] != labels[one] and linked(members[one][5], members[other][5], percent):
                yield members[one][0], members[other][0]
                labels[labels == labels[other]] = labels[one]


def groups_of(batches: Iterator[dict], names: list[str]) -> Iterator[list[list[tuple]]]:
    """Groups of rows sorted by (id, side, n, fp): the members of each side, a class once."""
    last, held = None, {}
    for batch in batches:
        for at, side, *member in zip(*(batch[c].to_pylist() for c in ("id", "side", *names))):
            if at != last:
                if held:
                    yield [list({m[0]: m for m in held[s]}.values()) for s in sorted(held)]
                last, held = at, {}
            elif side and len(held.get(side, ())) > LONGEST_BLOCK:
                # Members of the second side meet only the first, so they may do it in turns.
                yield [list({m[0]: m for m in held[s]}.values()) for s in sorted(held)]
                held[side] = []
            held.setdefault(side, []).append(tuple(member))
    if held:
        yield [list({m[0]: m for m in held[s]}.values()) for s in sorted(held)]


def by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition("id").sortWithinPartitions("id", "side", "n", "fp")


def sift(members: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Written once: (id, side, fp) of the members that the trees leave with a partner in another component; equal groups are one.

    `members` has (id, side, fp, label, homes); a group has one side or two. Only groups of more than one component are walked.
    """
    from xxhash import xxh3_128_digest

    mixed = members.groupBy("id").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l != h").select("id")
    rows = members.join(mixed, "id", "left_semi").join(maps, "fp")
    rows = by_group(rows.select("id", "side", "fp", "label", "n", "map", "homes"))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for groups in groups_of(batches, ["fp", "label", "n", "map", "homes"]):
            fps = [m[0] for g in groups for m in g]
            if len(fps) < 2:
                continue
            i, j, _ = open_pairs(groups, percent, [m[4] for g in groups for m in g])
            if not len(i):
                continue
            left = np.unique(np.r_[i, j]).tolist()
            cut = len(groups[0])
            found = [[fps[k] for k in left if (k >= cut) == side] for side in (False, True)] if len(groups) > 1 else [[fps[k] for k in left]]
            name = xxh3_128_digest(b"|".join(b"".join(f) for f in found))
            yield {"id": [name], "sides": [found]}

    groups = map_batches(rows, "id binary, sides array<array<binary>>", run).dropDuplicates(["id"])
    sides = groups.select("id", F.posexplode("sides").alias("side", "fps"))
    return stored(sides.select("id", "side", F.explode("fps").alias("fp")), "sifted")


def nowhere() -> Column:
    return F.array().cast("array<binary>")


def at_home(members: DataFrame) -> DataFrame:
    """(fp, home): the largest group of each class, so that large groups of near copies meet in one place."""
    sizes = members.groupBy("id").agg(F.count("*").alias("size"))
    chosen = members.join(sizes, "id").groupBy("fp").agg(F.max(F.struct("size", "id")).alias("m"))
    return chosen.select("fp", F.col("m.id").alias("home"))


def compare(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Written once: links (a, b) between the classes of each group of `members` (id, side, fp, label, homes).

    What is emitted is a forest, whatever the number of pairs that are compared. Texts travel instead of sets, as they are less than half as large.
    """
    rows = by_group(members.join(texts, "fp").select("id", "side", "fp", "label", "n", "text", "homes"))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for groups in groups_of(batches, ["fp", "label", "n", "text", "homes"]):
            full = [[(*m[:3], signature(t := shingles(m[3], size)[0]), m[4], t) for m in g] for g in groups]
            found = list(links_within(full, percent)) if sum(map(len, full)) > 1 else []
            if found:
                yield {"a": [f[0] for f in found], "b": [f[1] for f in found]}

    return stored(map_batches(rows, "a binary, b binary", run), "links")


def live_texts(docs: DataFrame, classes: DataFrame, live: DataFrame, size: int) -> DataFrame:
    """Written once: one text (fp, n, text) of each class in `live` (fp)."""
    wanted = live.join(classes, "fp").select("doc_id", F.col("fp").alias("want"))
    texts = docs.select("doc_id", "text").join(wanted, "doc_id")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            sizes, at = [], []
            for i, (value, want) in enumerate(zip(batch["text"], batch["want"].to_pylist())):
                tokens = shingles(value.as_py(), size)[0]
                # Another text with the same id is not the one looked for.
                if len(tokens) and fingerprint(tokens) == want:
                    sizes.append(len(tokens))
                    at.append(i)
            take = pa.array(at, pa.int64())
            yield {"fp": batch["want"].take(take), "n": sizes, "text": batch["text"].take(take)}

    return stored(map_batches(texts.select("text", "want"), "fp binary, n long, text string", run), "live")


def labelled(members: DataFrame, labels: DataFrame, homes: DataFrame | None = None) -> DataFrame:
    """`members` with the component of each class as label, and its homes so far."""
    known = labels.select(F.col("vertex").alias("fp"), "component")
    rows = members.join(known, "fp", "left")
    rows = rows.join(homes, "fp", "left") if homes is not None else rows.withColumn("homes", nowhere())
    return rows.select("id", "side", "fp", F.coalesce("component", "fp").alias("label"), "homes")


def labelled_pairs(blocks: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Members (id, side, fp, label, homes) of pairs of blocks of one shingle with fitting sizes that are not one component already."""
    parts = blocks.where("part").select("key", "id", "low", "high").distinct()
    one, two = parts.alias("one"), parts.alias("two")
    pairs = (
        one.join(two, F.col("one.key") == F.col("two.key"))
        .where("one.id != two.id and (one.low, one.high, one.id) < (two.low, two.high, two.id)")
        .where(F.col("two.low") * percent <= F.col("one.high") * 100)
        .select(F.col("one.id").alias("first"), F.col("two.id").alias("second"))
        .distinct()
    )
    members = blocks.where("part").groupBy("id").agg(F.first("fps").alias("fps"))
    members = members.select("id", F.lit(0).alias("side"), F.explode("fps").alias("fp"))
    members = stored(labelled(members, labels), "members")
    spans = members.groupBy("id").agg(F.min("label").alias("l"), F.max("label").alias("h"))
    a = spans.select(F.col("id").alias("first"), F.col("l").alias("la"), F.col("h").alias("ha"))
    b = spans.select(F.col("id").alias("second"), F.col("l").alias("lb"), F.col("h").alias("hb"))
    left = pairs.join(a, "first").join(b, "second").where("not (la = ha and lb = hb and la = lb)")
    left = stored(left.select("first", "second"), "pairs")
    name = F.concat("first", "second").alias("pair")
    sides = left.select(name, F.col("first").alias("id"), F.lit(0).alias("s")).unionByName(
        left.select(name, F.col("second").alias("id"), F.lit(1).alias("s"))
    )
    return sides.join(members, "id").select(F.col("pair").alias("id"), F.col("s").alias("side"), "fp", "label", "homes")


def link_components(docs: DataFrame, classes: DataFrame, size: int, percent: int, often: np.ndarray) -> DataFrame:
    """(vertex, component) of all classes with a link, both fingerprints."""
    routed = routes(docs, size, percent, often)
    blocks = blocked(routed, percent)
    maps = routed.select("fp", "n", "map").dropDuplicates(["fp"])
    inside = blocks.groupBy("id").agg(F.first("fps").alias("fps")).where(F.size("fps") > 1)
    inside = inside.select("id", F.lit(0).alias("side"), F.explode("fps").alias("fp"))
    inside = sift(inside.select("id", "side", "fp", F.col("fp").alias("label"), nowhere().alias("homes")), maps, percent)
    texts = live_texts(docs, classes, inside.select("fp").distinct(), size)

    # In each round a class meets those that share its largest open group with it: one text of each class travels.
    # The last round takes all groups in which a pair is still open.
    found = labels = homes = None
    groups = inside
    for left in reversed(range(ROUNDS)):
        members = groups.withColumn("label", F.col("fp")).withColumn("homes", nowhere()) if labels is None else labelled(groups, labels, homes)
        if left:
            home = at_home(groups)
            own = home.select("fp", F.array("home").alias("homes"))
            homes = own if homes is None else homes.join(home, "fp", "left").select("fp", F.concat("homes", F.array(F.coalesce("home", "fp"))).alias("homes"))
            homes = stored(homes, "homes")
            members = members.join(home.withColumnRenamed("home", "id"), ["fp", "id"], "left_semi")
        more = compare(members, texts, size, percent)
        found = more if found is None else found.unionByName(more)
        labels = components(found)
        if left:
            groups = sift(labelled(inside, labels, homes), maps, percent)
            if groups.isEmpty():
                break

    across = sift(labelled_pairs(blocks, labels, percent), maps, percent)
    apart = live_texts(docs, classes, across.select("fp").distinct().join(inside.select("fp").distinct(), "fp", "left_anti"), size)
    last = compare(labelled(across, labels), texts.unionByName(apart), size, percent)
    return components(found.unionByName(last))


def join(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, share: float = FREQUENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every row of `docs`."""
    profiles = profile(docs, size, share)
    often = frequent_tokens(profiles, share)
    rows = profiles.where("token is null").select("doc_id", "fp", "n")
    classes = rows.where("fp is not null and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    classes = stored(classes, "classes")
    found = link_components(docs, classes, size, percent, often)
    named = classes.join(found.select(F.col("vertex").alias("fp"), "component"), "fp", "left")
    named = stored(named.select("fp", "doc_id", F.coalesce("component", "fp").alias("component")), "named")
    tops = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(tops, "component").select("fp", "component_id")
    known = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.join(named, "fp", "left").select("doc_id", F.col("n").alias("n_shingles"), known.alias("component_id"))
