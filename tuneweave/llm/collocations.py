"""Phrase collocations by prefix-free parsing.

Texts are cut at punctuation into pieces and these, where they are long, into chunks: wherever the
hash of `longest - 1` words in a row is a trigger, a chunk ends with these words and
the next one begins with them. Triggers depend on content alone, so copies give the same
chunks. The dictionary of distinct chunks with their parse frequencies is stored; phrases are then counted
inside the distinct chunks, weighted by frequency. A phrase belongs to the chunk in
which it starts before the overlap, so each occurrence counts once.

Longer phrases are counted only where both their parts shorter by a word are
frequent: frequent phrases are hashed into a bit map of fixed size, which can let others pass but
holds back none; what passes is counted exactly, as text.

Defined results: a null or empty text has no words; a null language is `und`; repeated
rows count each time; ties in score go to the higher count, then to the phrase that is smaller in bytes; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneweave.llm.common import map_batches
from tuneweave.llm.vectors import Words, ranges, steps, to_spaces
from tuneweave.session import stored

LONGEST = 3
LEAST = 10
# A stretch of words is a trigger if its hash is 0 modulo this.
TRIGGER = 16
# Share of a phrase that lies inside one longer candidate, in percent, from which it is dropped.
INSIDE = 50
TOP = 2000
BITS = 24
# Bytes of text taken at a time: each word of them has some ten numbers in memory.
STEP = 2 << 20
CUT = 0x0A
# A-Z are lower-cased, tabs are spaces, punctuation and line ends are one byte that cuts.
TABLE = bytes(CUT if i in b".,;:!?\n\x0b\x0c\r" else 0x20 if i == 9 else i for i in range(256)).lower()
PARSE = "lang string, chunk string, last boolean, n long"
COUNTS = "lang string, phrase string, n long"
_words = to_spaces(b" ")


def hashes(values: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Number of each value among the distinct ones, and the hashes of these and the values."""
    import xxhash

    coded = values.dictionary_encode()
    listed = coded.dictionary.to_pylist()
    return (
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed)),
        listed,
    )


def chained(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` words in a row from the hashes of the words."""
    n = max(len(word) - size + 1, 0)
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = (mixed ^ word[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def parse(docs: DataFrame, longest: int = LONGEST, trigger: int = TRIGGER) -> DataFrame:
    """Distinct chunks of each language with their frequencies; `last` chunks end a piece and overlap no other."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in steps(batches, "text", STEP):
            words = Words(batch["text"], TABLE, CUT)
            n = words.count
            if not n:
                continue
            number, distinct, _ = hashes(words.values)
            piece = words.piece
            first = np.append(True, piece[1:] != piece[:-1])
            # The last word of the piece that each word lies in.
            ends = np.append(np.flatnonzero(first)[1:], n) - 1
            end = ends[np.cumsum(first) - 1]
            marks = np.zeros(n, bool)
            found = chained(distinct[number], longest - 1) % np.uint64(trigger) == 0
            marks[: len(found)] = found
            marks &= np.arange(n) + longest - 2 < end
            starts = np.flatnonzero(first | marks)
            # A chunk reaches to its piece's end or over the first words of the next chunk.
            last = np.append(first[starts[1:]], True)
            stops = np.where(last, end[starts], np.append(starts[1:], n) + longest - 2)
            sizes = stops - starts + 1
            lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(sizes)), words.values.take(pa.array(ranges(starts, sizes))))
            lang = batch["lang"].dictionary_encode()
            rows = pa.table(
                {
                    "lang": lang.indices.take(pa.array(words.text[starts])),
                    "chunk": pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())),
                    "last": last,
                    "n": np.ones(len(starts), np.int64),
                }
            )
            sums = rows.group_by(["lang", "chunk", "last"]).aggregate([("n", "sum")]).combine_chunks()
            columns = {c: sums[c].combine_chunks() for c in sums.column_names}
            yield {
                "lang": lang.dictionary.take(columns["lang"]),
                "chunk": columns["chunk"].cast(pa.large_string()),
                "last": columns["last"],
                "n": columns["n_sum"],
            }

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text"))
    return stored(map_batches(rows, PARSE, run).groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n")), "chunks")


def counted(chunks: DataFrame, size: int, longest: int, known: tuple[np.ndarray, int] | None = None) -> DataFrame:
    """Exact counts of the phrases of `size` words; with `known` only of those whose parts shorter by a word are in its bit map."""
    shared = chunks.sparkSession.sparkContext.broadcast(known) if known is not None else None

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        bits, width = shared.value if shared is not None else (None, 0)
        for batch in steps(batches, "chunk", STEP):
            words = Words(batch["chunk"], _words)
            number, distinct, listed = hashes(words.values)
            per = np.bincount(words.text, minlength=len(batch["chunk"]))
            # A phrase starts in a chunk before the words that the next one repeats.
            overlap = np.where(batch["last"].to_numpy(zero_copy_only=False), 0, longest - 1)
            ends = np.cumsum(per)
            at = np.arange(words.count)
            use = (at < (ends - overlap)[words.text]) & (at + size <= ends[words.text])
            coded = batch["lang"].dictionary_encode()
            lang = coded.indices.to_numpy(zero_copy_only=False)
            if bits is not None and words.count >= size:
                salts = np.array([salt_of(x) for x in coded.dictionary.to_pylist()], np.uint64)[lang][words.text]
                part = chained(distinct[number], size - 1)
                held = bits[slot_of(part, salts[: len(part)], width)]
                n = words.count - size + 1
                use[:n] &= held[:n] & held[1 : n + 1]
            starts = np.flatnonzero(use)
            if not len(starts):
                continue
            keys = [f"w{k}" for k in range(size)]
            rows = pa.table(
                {
                    "lang": lang[words.text[starts]],
                    "n": batch["n"].to_numpy()[words.text[starts]],
                    **{f"w{k}": number[starts + k] for k in range(size)},
                }
            )
            sums = rows.group_by(["lang", *keys]).aggregate([("n", "sum")]).combine_chunks()
            values = pa.array(listed, pa.large_binary())
            parts = [values.take(sums[k].combine_chunks()) for k in keys]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if size > 1 else parts[0]
            yield {
                "lang": coded.dictionary.take(sums["lang"].combine_chunks()),
                "phrase": phrase.cast(pa.large_string()),
                "n": sums["n_sum"].combine_chunks(),
            }

    return map_batches(chunks, COUNTS, run).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def salt_of(lang: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode())


def slot_of(hashed: np.ndarray, salts: np.ndarray, width: int) -> np.ndarray:
    return ((hashed ^ salts) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - width)


def bit_map(phrases: DataFrame, size: int, bits: int) -> tuple[np.ndarray, int]:
    """Which of 2^bits slots a phrase is hashed to: at most 2^bits / 32 rows come to the driver, whatever the number of phrases."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in steps(batches, "phrase"):
            words = Words(batch["phrase"], _words)
            number, distinct, _ = hashes(words.values)
            mixed = chained(distinct[number], size)[::size]
            coded = batch["lang"].dictionary_encode()
            salts = np.array([salt_of(x) for x in coded.dictionary.to_pylist()], np.uint64)
            slots = slot_of(mixed, salts[coded.indices.to_numpy(zero_copy_only=False)], bits).astype(np.int64)
            yield {"place": slots >> 5, "held": np.left_shift(np.int64(1), slots & 31)}

    found = map_batches(phrases.select("lang", "phrase"), "place int, held long", run).groupBy("place").agg(F.bit_or("held").alias("held"))
    table = found.toArrow()
    held = np.zeros(1 << max(bits - 5, 0), np.uint32)
    held[table["place"].to_numpy()] = table["held"].to_numpy().astype(np.uint32)
    return np.unpackbits(held.view(np.uint8), bitorder="little").astype(bool), bits


def frequent_phrases(chunks: DataFrame, longest: int, least: int, bits: int = BITS) -> list[DataFrame]:
    """Phrases of 1 to `longest` words that occur `least` times or more in a language."""
    found: list[DataFrame] = []
    for size in range(1, longest + 1):
        known = bit_map(found[-1], size - 1, bits) if found else None
        found.append(stored(counted(chunks, size, longest, known).where(F.col("f") >= least), f"phrases-{size}"))
    return found


def words_of(phrase: str = "phrase") -> Column:
    return F.split(phrase, " ")


def scored(phrases: list[DataFrame]) -> DataFrame:
    """lang, phrase, a, l, r, score of every candidate: its lowest-scoring cut, the first of equals.

    One join of all parts with their counts; common parts are skewed keys, which Spark's adaptive join splits.
    """
    candidates = phrases[1]
    for p in phrases[2:]:
        candidates = candidates.unionByName(p)
    held = phrases[0]
    for p in phrases[1:-1]:
        held = held.unionByName(p)
    words = F.col("words")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), words_of().alias("words")).select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k")
    )
    asked = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("left"), F.array_join(F.slice(words, 1, F.col("k")), " ").alias("part")),
                F.struct(F.lit(False).alias("left"), F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " ").alias("part")),
            )
        ).alias("side"),
    ).select("lang", "phrase", "a", "k", "side.*")
    parts = held.select("lang", F.col("phrase").alias("part"), "f")
    pairs = (
        asked.join(parts, ["lang", "part"])
        .groupBy("lang", "phrase", "a", "k")
        .agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    )
    # Products in decimals of 38 digits: exact for counts up to 10^16. A score is at most 1,000,000.
    score = "(cast(1000000 as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    lowest = pairs.withColumn("score", F.expr(score).cast("long")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return lowest.select("lang", "phrase", "a", "m.l", "m.r", "m.score")


def covered(phrases: list[DataFrame]) -> DataFrame:
    """Phrases of two words or more that lie inside a longer candidate, with the highest count of one."""
    parts = None
    for size in range(3, len(phrases) + 1):
        words = F.col("words")
        inner = F.flatten(
            F.array(
                *[
                    F.array(*[F.array_join(F.slice(words, start + 1, part), " ") for start in range(size - part + 1)])
                    for part in range(2, size)
                ]
            )
        )
        some = phrases[size - 1].select("lang", "f", words_of().alias("words")).select("lang", F.explode(inner).alias("phrase"), "f")
        parts = some if parts is None else parts.unionByName(some)
    return parts.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def first_of(rows: DataFrame, top: int) -> DataFrame:
    """The first `top` phrases of each language: of 64 parts of a language first, so that none is gathered whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top).drop("rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top)


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first phrases of each language of `docs` (lang, text)."""
    chunks = parse(docs, longest)
    phrases = frequent_phrases(chunks, longest, least)
    # Words of a chunk before the overlap, times its frequency.
    spaces = F.length("chunk") - F.length(F.replace("chunk", F.lit(" "), F.lit("")))
    own = spaces + 1 - F.when(F.col("last"), 0).otherwise(longest - 1)
    totals = chunks.groupBy("lang").agg(F.sum(own * F.col("n")).alias("n"))
    found = stored(scored(phrases), "scored")
    if longest > 2:
        found = found.join(covered(phrases), ["lang", "phrase"], "left").where(
            F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True))
        )
    best = first_of(found.select("lang", "phrase", "a", "l", "r", "score"), top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
