"""Token files, collocations and lexical search against libraries, brute force and SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tuneweave.llm import collocations, lexical_search, token_files, vectors
from tuneweave.llm.queries import QUERIES, vocabulary
from tuneweave.llm.vectors import Words, space_chunks, steps, to_spaces

FOLDER = "/root/testdata/sf0.001"
pytest.importorskip("public_tokenizers")
TRICKY = [
    None,
    "",
    " ",
    "It's we'll,  DON'T.. stop!!! 12,345.67 ﬁ é İ ß Σας",
    "\n \n  a\r\nb c d\x0b\x00e\x1c f\x85g",
    "é ́x á̧ <|endoftext|> x<|startoftext|>y",
    "日本語 のテキスト 🙂🙂  emoji",
    "word " * 4000,
    "long" * 3000,
    "word " * 4000,
]


def test_values_survive_the_coding():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        values = rnd.integers(0, 1 << 32, n, dtype=np.uint64) >> rnd.integers(0, 32, n, dtype=np.uint64)
        control, data = token_files.encode(values.astype(np.uint32))
        assert len(control) == -(-n // 4) and token_files.decode(control, data, n).tolist() == values.tolist()
    control, data = token_files.encode(np.array([255, 256, 65536, 1 << 24]))
    assert control.tolist() == [0b11100100] and data.tolist() == [255, 0, 1, 0, 0, 1, 0, 0, 0, 1]


def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    assert token_files.drops_white_space(path) and not token_files.drops_white_space(vocabulary("byte_bpe_50k.json"))
    # Key 5 is held by several rows, two documents have no key.
    rows = [(None if i in (3, 6) else 5 if i in (1, 4, 7) else 100 - i, t) for i, t in enumerate(TRICKY)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "'x' as N", "2 as part").repartition(3)
    got = token_files.round_trip(docs, lambda: token_files.load_tokenizer(path)).orderBy("start").collect()
    want = Counter((k, bytes(np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4"))) for k, t in rows)
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    empty = token_files.round_trip(docs.limit(0), lambda: token_files.load_tokenizer(path))
    assert empty.collect() == [] and empty.columns == ["doc_id", "start", "n_tokens", "ids"]


def test_many_chunks_are_one_text_of_the_library():
    from tokenizers import Tokenizer

    class Counted:
        given = 0

        def __getattr__(self, name):
            return getattr(own, name)

        def encode_batch_fast(self, texts, **options):
            self.given += len(texts)
            return own.encode_batch_fast(texts, **options)

    own, counted = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), Counted()
    chunks = [f"w{i}x'{i % 7}s".encode() for i in range(1000)]
    odd = ["a<|startoftext|>", "<|startoftext|>", "<|startoftext|", "<|startof", "<", "é́", "\x00", "<|endoftext|>b", "'", "s"]
    mark = token_files.mark_of(counted)
    assert mark == ("<|startoftext|>", 49406)
    encode = token_files.joint_encoder(counted, mark)
    assert encode([]) == [] and encode(chunks) == [own.encode(c.decode(), add_special_tokens=False).ids for c in chunks]
    assert counted.given < 50
    mixed = [*chunks[:100], *(t.encode() for t in odd), *chunks[100:]]
    assert encode(mixed) == [own.encode(c.decode(), add_special_tokens=False).ids for c in mixed]
    assert token_files.joint_encoder(own, None)(mixed) == encode(mixed)


def test_only_marks_that_nothing_can_swallow():
    from tokenizers import AddedToken, Tokenizer, models

    def found(*tokens):
        own = Tokenizer(models.BPE())
        own.add_special_tokens([AddedToken(t, normalized=False) if isinstance(t, str) else t for t in tokens])
        return token_files.mark_of(own)

    assert found() is None and found("<a>", "<b>")[0] == "<a>"
    assert found("<a>", "<a>x")[0] == "<a>x" and found("<a>", "x<")[0] == "x<"
    assert found("aba") is None
    assert found(AddedToken("<a>", normalized=False, lstrip=True), AddedToken("<b>", normalized=True)) is None


def test_coder_keeps_what_several_steps_ask_for(monkeypatch):
    """A full memory keeps the chunks in use; before, all were forgotten and encoded again."""
    monkeypatch.setattr(vectors, "CACHE", 20_000)
    encoded = Counter()

    def encode(chunks):
        encoded.update(chunks)
        return [list(c) for c in chunks]

    coder = vectors.Coder(encode, 7)
    common = [b"", *(b"c%d" % i for i in range(20))]
    for step in range(30):
        chunks = [*common, *(b"%d-%d" % (step, i) for i in range(40)), *common]
        ids, lengths = coder.ids(pa.array(chunks, pa.large_binary()), np.arange(len(chunks)), len(chunks))
        assert ids.tolist() == [i for c in chunks for i in [*c, 7]] and lengths.tolist() == [len(c) + 1 for c in chunks]
        assert coder.memory < 20_000 + 61 * 200 and coder.used <= len(coder.flat)
    assert all(encoded[c] == 1 for c in common) and len(coder.known) < 300


def test_token_files_of_large_ids_in_many_blocks(spark, monkeypatch):
    """An encoder of the user's own with ids of every width, in small blocks and files."""
    monkeypatch.setattr(token_files, "BLOCK", 7)
    monkeypatch.setattr(token_files, "LEAST", 50)

    def load():
        def run(texts):
            parts = [[int(x) for x in t.as_py().split()] + [9] for t in texts]
            return np.array([i for p in parts for i in p], np.uint32), np.array([len(p) for p in parts])

        return run

    rnd = random.Random(1)
    texts = [" ".join(str(rnd.choice([rnd.randrange(20), rnd.randrange(70_000)])) for _ in range(rnd.randrange(30))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = token_files.round_trip(docs, load).orderBy("doc_id").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [[*map(int, t.split()), 9] for t in texts]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()


def test_chunks_and_words_of_batches():
    texts = ["", " a  b", "ab c", " ", "x  ", None, "é é"]
    chunks, owner = space_chunks(pa.array(texts))
    joined = [b"".join(c for c, o in zip(chunks.to_pylist(), owner) if o == i) for i in range(len(texts))]
    assert joined == [(t or "").encode() for t in texts]
    # A space before the last of several white spaces keeps its text whole.
    assert Counter(owner.tolist())[4] == 1 and Counter(owner.tolist())[2] == 2
    words = Words(pa.array(texts), to_spaces(b" "))
    assert words.values.to_pylist() == [b"a", b"b", b"ab", b"c", b"x", "é".encode(), "é".encode()]
    assert words.text.tolist() == [1, 1, 2, 2, 4, 6, 6]
    batches = [{"text": pa.array(["abc", None, "d" * 50, ""])}, {"text": pa.array([], pa.string())}, {"text": pa.array(["e"] * 9)}]
    cut = list(steps(iter(batches), "text", 8))
    assert [t for b in cut for t in b["text"].to_pylist()] == ["abc", None, "d" * 50, "", *["e"] * 9] and len(cut) > 2


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(docs, longest, least, inside, top):
    counts, totals, out = {}, Counter(), []
    for lang, text in docs:
        lang, own = lang or "und", counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= inside * a for b in longer):
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("longest", "trigger", "bits", "top"), [(3, 16, 24, 2000), (3, 2, 6, 40), (4, 3, 12, 2000), (2, 2, 1, 2000)])
def test_collocations_equal_brute_force(spark, monkeypatch, longest, trigger, bits, top):
    monkeypatch.setattr(collocations.parse, "__defaults__", (3, trigger))
    monkeypatch.setattr(collocations.frequent_phrases, "__defaults__", (bits,))
    rnd = random.Random(longest * trigger)
    words = ["a", "B", "c", "Éa", "d e", "naïve", "x", "y-z", "the", "of"]
    docs = [(None, None), ("en", ""), ("fr", " \t.,"), ("en", "a"), (None, "a B. a b!\na b,a b;a b:a b?a b\x0ba b\x0ca b\ra b a b"), ("en", "one " * 300)]
    for _ in range(150):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ","]) for _ in range(rnd.randrange(60)))
        docs += [(rnd.choice(["en", "fr", "und", None]), text)] * rnd.choice([1, 1, 3])
    table = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 as n", "'x' as chunk", "2 as Phrase").repartition(3)
    got = collocations.collocations(table, longest, 10, 50, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(docs, longest, 10, 50, top)
    assert collocations.collocations(table.limit(0), longest).collect() == []


def test_copies_parse_into_the_same_chunks(spark):
    text = " ".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz", k=4000))
    docs = spark.createDataFrame([("en", text), ("en", text), ("en", "q " + text)], "lang string, text string")
    rows = collocations.parse(docs).collect()
    # The third text differs before its first trigger only.
    assert sum(r.n for r in rows) > 2.9 * len(rows) > 300 and sum(r.n for r in rows if r["last"]) == 3


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k):
    tfs = [(key, Counter(TERM.findall((text or "").translate(LOWER)))) for key, text in docs]
    tfs = [(key, c, sum(c.values())) for key, c in tfs if c]
    df, total, out = Counter(t for _, c, _ in tfs for t in c), len(tfs), []
    length = sum(n for *_, n in tfs)
    for item, text in items:
        terms, found = TERM.findall((text or "").translate(LOWER)), []
        for key, c, n in tfs:
            m = 100 - 25 + (25 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                found.append((-score, -1 if key is None else key))
        out += [(item, i, None if key == -1 else key, -s) for i, (s, key) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("rows", "block", "warm", "size"), [(8192, 24, 4096, 1024), (40, 3, 10, 1024), (64, 1, 1, 3)])
def test_lexical_search_equals_brute_force(spark, monkeypatch, rows, block, warm, size):
    for name, value in {"SHARD_ROWS": rows, "BLOCK": block, "WARM": warm, "ITEMS": size}.items():
        monkeypatch.setattr(lexical_search, name, value)
    rnd = random.Random(rows)
    words = [f"w{i}" for i in range(200)] + ["É", "naïve", "X1", "日本"]
    draw = lambda n: " ".join(words[min(int(rnd.expovariate(0.03)), len(words) - 1)] for _ in range(n))
    docs = [(0, None), (1, ""), (2, "... --"), (None, "w1 w2 É"), (3, "w1 w2 É"), (3, "w1 w2 É"), (4, "É é X1 x1_x1")]
    docs += [(i, draw(rnd.randrange(1, 80))) for i in range(5, 400)]
    docs += [(i, docs[20][1]) for i in range(400, 440)]
    items = [(1, "W1 é É x1"), (1, "w3 w3 w3 w150"), (2, None), (3, "!"), (4, "unknown"), (5, docs[20][1]), (6, "w0 " * 5 + "w190 w191")]
    items += [(i, draw(rnd.randrange(1, 30))) for i in range(7, 20)]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as Stats").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 as rank", "7 as score")
    got = lexical_search.search(table, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items, 20)
    assert lexical_search.search(table.limit(0), asked).collect() == lexical_search.search(table, asked.limit(0)).collect() == []


def test_blocks_below_the_limit_are_skipped(monkeypatch):
    """Summaries are exact upper bounds, and most lists and blocks of a clustered shard stay closed."""
    rnd = np.random.default_rng(2)
    width, n = 60, 4000
    terms = [np.unique(np.append(rnd.integers(0, 6, 4), 6 + (i % 9) * 6 + rnd.integers(0, 6, 4))) for i in range(n)]
    score = [rnd.integers(1, 100, len(t)) * (50 if i < 30 else 1) for i, t in enumerate(terms)]
    ends = np.append(0, np.cumsum([len(t) for t in terms]))
    shard = lexical_search.Shard(np.arange(n), ends, np.concatenate(terms), np.concatenate(score), width)
    docs, cuts, coordinates, maxima, bounds = shard.blocks(7)
    assert sorted(docs) == [i for i, t in enumerate(terms) if 7 in t] and len(cuts) > 10
    for b in range(len(cuts) - 1):
        own = dict(zip(coordinates[bounds[b] :][: np.append(bounds, len(coordinates))[b + 1] - bounds[b]], maxima[bounds[b] :]))
        want = Counter()
        for d in docs[cuts[b] : cuts[b + 1]]:
            for t, s in zip(terms[d], score[d]):
                want[t] = max(want[t], s)
        assert own == want
    taken, add = [], lexical_search.Best.add
    monkeypatch.setattr(lexical_search.Best, "add", lambda self, s, i: (taken.append(len(i)), add(self, s, i))[1])
    best = lexical_search.Best(3)
    shard.search(np.array([7, 8, 0, 1]), np.array([1, 1, 1, 2]), best, np.zeros(width, np.int64))
    asked = {7: 1, 8: 1, 0: 1, 1: 2}
    totals = [sum(asked.get(t, 0) * s for t, s in zip(terms[d], score[d])) for d in range(n)]
    assert best.scores.tolist() == sorted(totals, reverse=True)[:3] and sum(taken) < n / 4


def test_queries_of_the_tables(spark):
    rows = QUERIES["op11_token_files"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count() and min(r.start for r in rows) == 0
