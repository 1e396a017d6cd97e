"""Tokens, packing, language, quality and pages: against the libraries, brute force and held-out labels."""

import base64
import hashlib
import zlib

import numpy as np
import pytest

from tuneweave.llm import bpe, html_text, language_id, packing, quality, token_counts
from tuneweave.llm.queries import QUERIES, vocabulary

FOLDER = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")
TRICKY = [
    None,
    "",
    " ",
    "  ",
    "a  b\n\n c\t d  ",
    "x▁y <s> </s> <|endoftext|> end",
    "<|endoftext|>",
    "It's we'll,  don't.. stop!!! 12,345.67 ﬁ é İ ß",
    "\n \n  a\r\nb\u00a0c\u2003d\x0b\x00e",
    "日本語 のテキスト 🙂🙂  emoji",
    "a, b., c.,; ,. .",
    " lead\n trail \n",
    "word " * 4000,
    "long" * 3000,
    "word " * 4000,
]


def frame(spark, texts, extra=""):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_packing_gives_every_id_once(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = {i: np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in enumerate(TRICKY)}
    path = vocabulary("byte_bpe_50k.json")
    rows = packing.pack(frame(spark, TRICKY).repartition(3), lambda: packing.load_tokenizer(path)).collect()
    places = {}
    for r in rows:
        ids = want[r.doc_id]
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids)
        places.setdefault(("doc", r.doc_id), []).append((r.start, r.length))
        places.setdefault(("seq", r.sequence_id), []).append((r.offset, r.length))
    last = max(k[1] for k in places if k[0] == "seq")
    for (kind, key), parts in places.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(want[key]) if kind == "doc" else at == packing.WIDTH or key == last
    assert len([k for k in places if k[0] == "doc"]) == len(TRICKY)


def test_packing_of_nothing(spark):
    path = vocabulary("byte_bpe_50k.json")
    assert packing.pack(frame(spark, TRICKY).limit(0), lambda: packing.load_tokenizer(path)).collect() == []


def test_bpe_equals_the_library(spark):
    import tiktoken

    path, pattern = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    coded = frame(spark, TRICKY).select("doc_id", bpe.encode(path, pattern)("text").alias("ids"))
    for r in coded.select("doc_id", "ids", bpe.decode(path, pattern)("ids").alias("data")).collect():
        assert list(r.ids) == own.encode_ordinary(TRICKY[r.doc_id] or "")
        assert bytes(r.data) == (TRICKY[r.doc_id] or "").encode()


def test_bpe_digests_in_one_pass(spark):
    import tiktoken

    path, pattern = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    docs = frame(spark, [*TRICKY, *TRICKY]).selectExpr("doc_id % 15 as doc_id", "text", "1 as ids", "'x' as N_TOKENS").repartition(3)
    rows = bpe.round_trip(docs, path, pattern).collect()
    assert len(rows) == 2 * len(TRICKY)
    for r in rows:
        text = TRICKY[r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), path, pattern).collect() == []


def test_bpe_equals_the_library_on_random_texts():
    """Chunks between spaces and before points, merges and remembered pairs, against the library."""
    import random

    import pyarrow as pa
    import tiktoken

    path, pattern = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own, rnd = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), random.Random(9)
    alphabet = "abcdefghijklmnopqrstuvwxyzABC  .,;'!?\n\t0123éèñóüß日本🙂  \u0301\u00d7\u2003"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80))) for _ in range(3000)]
    ids, lengths = bpe.codec(path, pattern).encode_texts(pa.array(texts))
    ends = np.append(0, np.cumsum(lengths))
    assert all(ids[i:j].tolist() == own.encode_ordinary(t) for t, i, j in zip(texts, ends, ends[1:]))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_encoding_equals_the_library_on_random_texts(name):
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    from tuneweave.llm import token_files

    own, rnd = Tokenizer.from_file(vocabulary(name)), random.Random(4)
    parts = [*"abcdeABCÉéñß日🙂'.,;:!?-_<|>  \n\t\r\x0b\x1c\u00a0\u0301\u00d7\u212a\u0130", "<|endoftext|>", "'s", "n't", "  ", " \n", "..."]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    run = packing.load_tokenizer(vocabulary(name)) if name[:4] == "byte" else token_files.load_tokenizer(vocabulary(name))
    ids, lengths = run(pa.array(texts))
    ends = np.append(0, np.cumsum(lengths))
    last = [] if name[:4] == "byte" else [2]
    bad = [t for t, i, j in zip(texts, ends, ends[1:]) if ids[i:j].tolist() != own.encode(t, add_special_tokens=False).ids + last]
    assert not bad, bad[:3]


def test_packing_of_repeated_ids_and_clashing_columns(spark):
    path = vocabulary("byte_bpe_50k.json")
    docs = frame(spark, ["a b c", "a b c", None]).selectExpr("7L as doc_id", "text", "'x' as ids", "1 as Start", "2 as part")
    rows = packing.pack(docs, lambda: packing.load_tokenizer(path)).collect()
    assert [r.doc_id for r in rows] == [7, 7, 7] and sorted(r.doc_tokens for r in rows) == [1, 4, 4]


def test_perfect_hash_is_minimal():
    keys = [f"k{i}".encode() for i in range(3000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.index) == list(range(3000)) and [table.find(k) for k in keys] == list(range(3000))
    codec = bpe.Codec([(b"a", 0), (b"b", 1), (b"ab", 2)], r"\S+")
    assert codec.encode("abab").tolist() == [2, 2] and codec.decode(np.array([2, 0])) == b"aba"
    with pytest.raises(ValueError):
        codec.decode(np.array([9]))


@pytest.mark.parametrize("share", [2.0**-18, 0.02, 1.0])
def test_token_counts_equal_the_library(spark, share):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = frame(spark, TRICKY).union(frame(spark, TRICKY)).repartition(3)
    rows = token_counts.count_tokens(docs, path, share).collect()
    assert len(rows) == 2 * len(TRICKY)
    for r in rows:
        text = TRICKY[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(own.encode(text)))
        assert r.over_limit == (r.n_tokens > 4096)
    assert token_counts.count_tokens(docs.limit(0), path).collect() == []


def brute_base(text):
    words, lines, again = (text or "").encode().split(), (text or "").split("\n"), set()
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            again.update(k for i in at for k in range(i, i + 5))
    dup = sum(1 for i, x in enumerate(lines) if x.encode().split() and x in lines[:i])
    chars = sum(c not in " \t\n\x0b\x0c\r" for c in text or "")
    return len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), dup, len(again)


def test_quality_base_counts():
    texts = [*TRICKY[:-3], "a b c d e a b c d e f\n\nx\nx\n \n \nx # |", "q w e r t q w e r t", "a " * 40]
    for t in texts:
        assert quality.base_counts(t) == brute_base(t)


def test_quality_query_separates_labels(spark):
    rows = {r.doc_id: r for r in QUERIES["op8_quality"](spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    good = [rows[r.doc_id].kept for r in labels if r.quality == 1 and not rows[r.doc_id].base_failed]
    bad = [rows[r.doc_id].kept for r in labels if r.quality == 0]
    assert all(good) and np.mean(bad) < 0.2 and len(rows) == 200


def test_quality_without_labels_and_with_clashing_names(spark):
    docs = frame(spark, [None, "", "w " * 30, " ".join(map(str, range(30)))]).selectExpr("*", "1 as kept", "'s' as Score")
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    out = quality.judge(docs, quality.log_ratios(docs, labels))
    assert [c.lower() for c in out.columns].count("kept") == 1
    assert [(r.base_failed, r.kept, r.score) for r in out.orderBy("doc_id").collect()] == [
        (True, False, 0.0), (True, False, 0.0), (True, False, 0.0), (False, True, 0.0)
    ]


def test_language_held_out_accuracy(spark):
    rows = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    apart = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in apart]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    docs = spark.createDataFrame(
        [(0, None, "en"), (1, "", "en"), (2, "123 !!", "en"), (3, "the cat and the dog", "en"), (4, "le chat et le chien", "fr"), (5, "x" * 100_000, None)],
        "doc_id long, text string, lang string",
    ).selectExpr("*", "'old' as lang_pred")
    out = language_id.identify(docs, language_id.fit(docs)).orderBy("doc_id").collect()
    assert [r.lang_pred for r in out[:5]] == ["und", "und", "und", "en", "fr"] and out[5].lang_pred in ("en", "fr")
    none = language_id.identify(docs, language_id.fit(docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    one = language_id.identify(docs, language_id.fit(docs.where("doc_id = 3"))).collect()
    assert {r.lang_pred for r in one} == {"und", "en"}


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a = "</p>";</script></head><body>
<header>Site <h2>name</h2></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it work and to count visits.</div>
<article><h1>Short</h1><p>A first  <b>bold</b> paragraph &amp; more&nbsp;text.<br>Next line.<p>Two
<div class="ad">Buy now and save a lot of money today with this offer.</div><form>Name <input name=q></form>
<ul><li>item<li>other</ul><!-- no <p>gone</p> --></article>
<aside>Related reading that is quite long but not part of the article at all.</aside>
<div id="comments"><p>I liked this very much, thanks for writing all of it down.</p></div>
<footer>&copy; someone</footer></body></html>"""


def test_html_main_text(spark):
    want = "Short A first bold paragraph & more text. Next line. Two item other"
    assert html_text.main_text(PAGE) == want
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p>cut <b"), (5, "<article><p>x &lt;b&gt;")], "page_id long, html string")
    out = html_text.extract(pages.selectExpr("*", "'old' as TEXT")).orderBy("page_id").collect()
    assert [r.text for r in out] == [want, "", "", "", "x <b>"] and [r.n_chars for r in out] == [len(want), 0, 0, 0, 5]


def test_html_without_an_article():
    prose = "This paragraph has more than enough words to be taken for the main text of a page by its length. " * 3
    page = f"<body><ul><li><a>Home</a><li><a>News</a></ul><p>{prose}</p><p>{prose}</p><div class=footer>All rights</div></body>"
    assert html_text.main_text(page) == " ".join([prose.strip()] * 2)


@pytest.mark.parametrize("name", ["audio", "video", "canvas", "noscript", "template", "svg", "math", "object", "select"])
def test_html_hidden_elements_without_end_tag(name):
    first, more = "The first paragraph of the article is here.", "Another paragraph of the article that follows it."
    keep = f"{first} {more}"
    for form in (f"<{name} id=x />", f"<{name} src='x'/>", f"<{name}>gone</{name}>", f"<{name}><b>gone<{name}>gone</{name}></b></{name}>"):
        assert html_text.main_text(f"<article><p>{first}</p>{form}<p>{more}</p></article>") == keep
    assert html_text.main_text(f"<article><p>{first}</p><div><{name}>gone</div><p>{more}</p></article>") == keep
    page = f"<article><p>{first}</p><div><{name}>gone<b>gone</div><p>{more}</p><div><{name}>gone</{name}></div></article>"
    assert html_text.main_text(page) == keep
    assert html_text.main_text(f"<head><{name}>gone<body><article><p>{first}</p><p>{more}</p></article>") == keep


def test_html_media_end_with_their_paragraph_and_raw_elements_with_the_page():
    assert html_text.main_text("<article><p>One two three.<video src=x>gone<p>Four five six.<audio>gone<h2>Seven</h2></article>") == (
        "One two three. Four five six. Seven"
    )
    for name in ("script", "style", "title", "textarea"):
        assert html_text.main_text(f"<article><p>One two three.</p><div><{name}>gone</div><p>gone</p></article>") == "One two three."


LONG = "This paragraph of the article has a good many words and is by no means a part of the furniture of the page. " * 8


@pytest.mark.parametrize(
    "wrapper",
    ["div id=page class='layout has-sidebar'", "div class='no-comments'", "section class='sidebar widget'", "div id=comments", "form id=aspnet", "div role=search"],
)
@pytest.mark.parametrize("article", ["article class='post category-social'", "article class='social widget'", "main class=banner"])
def test_html_article_and_what_is_around_it_are_no_furniture(wrapper, article):
    page = f"<{wrapper}><nav><a href=/>Home</a></nav><{article}><h1>Short</h1><p>{LONG}</p><p>Two words.</p><div class=ad>Buy now and save a lot.</div>"
    page += f"</{article.split()[0]}></{wrapper.split()[0]}>"
    assert html_text.main_text(page) == f"Short {LONG.strip()} Two words."


def test_html_parts_of_class_names_do_not_count():
    for name in ("has-sidebar", "no-comments", "category-social", "post-with-ad-free-text"):
        assert not any(b.furniture for b in html_text.blocks(f"<div class='x {name}'><p>{LONG}</p></div>"))
    assert all(b.furniture for b in html_text.blocks(f"<div class='x sidebar'><p>{LONG}</p></div>"))


def test_html_long_marked_block_in_an_article():
    assert html_text.main_text(f"<article><h1>T</h1><div class=widget><p>{LONG}</p><p>{LONG}</p></div></article>") == " ".join(["T", *[LONG.strip()] * 2])


def test_html_comments_as_articles():
    comment = "<article class=comment-body><p>I liked this very much, thanks for writing all of it down.</p></article>"
    page = f"<main><article><p>{LONG}</p></article><div id=comments>{comment}{comment}</div></main>"
    assert html_text.main_text(page) == LONG.strip()


@pytest.mark.parametrize("name", ["op2_packing", "op3_bpe", "op9_token_counts", "op7_html_text"])
def test_queries_keep_every_row(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    table = "pages" if name == "op7_html_text" else "documents"
    key = "page_id" if name == "op7_html_text" else "doc_id"
    assert {r[key] for r in rows} == {r[key] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect()}
    if name == "op3_bpe":
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
        assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
