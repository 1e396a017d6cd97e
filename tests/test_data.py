"""Sampling, packing, conversations and scoring against brute force, under several partitionings."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from tuneweave.functions.tokenizers import token_ids
from tuneweave.operators import conversations, evaluation, language, packing, sampling, scoring
from tuneweave.params import PrepareParams, TrainLayout, ParameterError
from tuneweave.plans.prepare import prepare_chat, prepare_instructions, preprocess_summary
from tuneweave.sources.tables import filter_language, read_instructions

DOCS = [(i, " ".join(f"w{i}_{j}" for j in range((i * 7) % 23))) for i in range(200)] + [(200, "long " * 3000)]
PARTS = [1, 4, 64]


def order(tag, key, seed=3, *more):
    return hashlib.md5(":".join([str(seed), tag, *more, str(key)]).encode()).hexdigest(), key


def docs(spark, parts=4):
    return spark.createDataFrame(DOCS, "doc_id long, text string").repartition(parts)


@pytest.mark.parametrize("parts", PARTS)
@pytest.mark.parametrize("n", [1, 57, 201, 500])
def test_sample_is_exact(spark, parts, n):
    got = {r.doc_id for r in sampling.sample_n(docs(spark, parts), n, "doc_id", 3).collect()}
    assert got == set(sorted((d[0] for d in DOCS), key=lambda k: order("sample", k))[:n])


def test_sample_of_all_and_of_none(spark):
    assert sampling.sample_n(docs(spark), None, "doc_id", 3).count() == 201
    with pytest.raises(ValueError):
        sampling.sample_n(docs(spark), 0, "doc_id", 3)


@pytest.mark.parametrize("parts", PARTS)
def test_split_has_the_exact_size(spark, parts):
    rows = sampling.split_exact(docs(spark, parts), 0.2, "doc_id", 3).collect()
    held_out = {r.doc_id for r in rows if r.split == "validation"}
    assert len(rows) == 201
    assert held_out == set(sorted((d[0] for d in DOCS), key=lambda k: order("split", k))[: math.ceil(201 * 0.2)])


def test_sample_does_not_pick_one_split(spark):
    ids = spark.range(4000).withColumnRenamed("id", "k")
    labelled = sampling.split_hash(sampling.sample_n(ids, 400, "k", 9), 0.2, "k", 9)
    counts = {r.split: r.n_rows for r in sampling.split_counts(labelled).collect()}
    assert 40 < counts["validation"] < 130


def test_calibration(spark):
    assert tuple(sampling.calibration_report(docs(spark), 128).first()) == (128, 201, 128)
    assert tuple(sampling.calibration_report(docs(spark).limit(20), 128).first()) == (128, 20, 20)
    rows = sampling.calibration_sample(docs(spark), 201, 5, "doc_id", 3).collect()
    assert max(r.n_tokens for r in rows) == 5 and all(len(r.text.split()) == r.n_tokens for r in rows)


@pytest.mark.parametrize("parts", PARTS)
def test_packing(spark, parts):
    block = 64
    stream = []
    for key, text in sorted(DOCS, key=lambda d: order("pack", d[0])):
        stream += text.split() + ["<eos>"]
    want = {c: stream[c * block : (c + 1) * block] for c in range(len(stream) // block)}
    got = packing.pack_blocks(docs(spark, parts), block, "doc_id", 3).collect()
    assert {r.chunk_id: r.tokens for r in got} == want
    counted = docs(spark, parts).withColumn("n", F.size(F.split("text", " ")) - (F.col("text") == "").cast("int") - F.col("text").endswith(" ").cast("int"))
    again = packing.pack_blocks(counted, block, "doc_id", 3, length="n").collect()
    assert {r.chunk_id: r.tokens for r in again} == want
    stats = packing.pack_stats(docs(spark, parts), block, "doc_id", seed=3).first()
    assert (stats.n_docs, stats.n_tokens, stats.n_blocks) == (201, len(stream), len(want))
    assert stats.dropped_tokens == len(stream) % block
    assert sum(r.n_docs for r in got) == pytest.approx(stats.docs_per_block * len(want))


@pytest.mark.parametrize("parts", PARTS)
@pytest.mark.parametrize("max_steps", [None, 11])
def test_step_plan(spark, parts, max_steps):
    layout = TrainLayout(batch_size=4, gradient_accumulation=3, epochs=2, max_steps=max_steps, logging_steps=2, eval_steps=5)
    want, per_epoch = set(), math.ceil(201 / 12)
    for epoch in range(2):
        keys = sorted((d[0] for d in DOCS), key=lambda k: order("step", k, 3, str(epoch)))
        for rank, key in enumerate(keys):
            step = epoch * per_epoch + rank // 12 + 1
            if max_steps is None or step <= max_steps:
                want.add((epoch, step, rank % 12 // 4, rank % 4, key, step % 2 == 0, step % 5 == 0, step % 5 == 0))
    got = packing.step_plan(docs(spark, parts), "doc_id", layout, 3).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def turn_rows():
    rows = []
    for conv in range(12):
        for turn in range(conv * 9):
            role = ["user", "assistant", "tool", "system"][(turn + conv) % (4 if conv % 2 else 2)]
            rows.append((conv, turn, role, f" t{conv}.{turn} more "))
    # One conversation with a third of all rows, most of them dropped by the template.
    rows += [(99, t, "tool" if t % 5 else "user", f"h{t}") for t in range(600)]
    return rows


@pytest.mark.parametrize("parts", PARTS)
def test_long_conversations_are_whole(spark, parts):
    turns = spark.createDataFrame(turn_rows(), "conv_id long, turn long, role string, text string").repartition(parts)
    rendered = conversations.render_conversations(turns, "fallback", eos="|").collect()
    assert sum(len(r.messages) for r in conversations.assemble_conversations(turns).collect()) == len(turn_rows())
    for conv in (5, 11, 99):
        got = "".join(r.text for r in rendered if r.conv_id == conv)
        assert got == "|".join(f"{role.capitalize()}: {text.strip()}" for c, _, role, text in turn_rows() if c == conv)


@pytest.mark.parametrize("parts", PARTS)
@pytest.mark.parametrize("limit", [1, 5, 16, 100, 5000])
def test_conversation_cutoff(spark, parts, limit):
    turns = spark.createDataFrame(turn_rows(), "conv_id long, turn long, role string, text string").repartition(parts)
    got = {r.conv_id: r for r in conversations.conversation_texts(turns, "qwen", limit, eos="</s>").collect()}
    texts = {}
    for conv, _, role, text in turn_rows():
        block = f"<|im_start|>{role}\n{text.strip()}<|im_end|>"
        texts[conv] = texts.get(conv, "") + {"tool": "", "assistant": block + "</s>"}.get(role, block + "\n")
    assert set(got) == {c for c, t in texts.items() if t}
    for conv, row in got.items():
        n = len(texts[conv].split())
        whole = "".join(re.findall(r"\s*\S+", texts[conv])[:limit]) if n > limit else texts[conv]
        assert (row.text, row.n_tokens, row.was_cut) == (whole, min(n, limit), n > limit)


def test_turn_pairs(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "assistant", "d")]
    pairs = conversations.turn_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in pairs.collect()] == [(1, 0, "a", "b")]


def test_language_filter(spark):
    rows = spark.createDataFrame([(1, "en"), (2, "fr"), (3, None)], "id long, lang string")
    assert filter_language(rows, ["EN"]).count() == 1
    assert filter_language(rows, None).count() == 3
    with pytest.raises(ValueError):
        filter_language(rows, [])


def test_prepare_and_summary(spark):
    rows = [(1, "a", "", "x y", "en"), (2, "b", "i", " ", "en"), (3, "c", None, "z", "fr"), (4, "d", "", "w", "de")]
    corpus = spark.createDataFrame(rows, "id long, instruction string, input string, output string, lang string")
    params = PrepareParams.from_mapping({"sample_size": "full", "filter_langs": "en, fr", "test_size": 0.25, "eos": "</s>"})
    got = {r.id: r for r in prepare_instructions(corpus, params).collect()}
    assert set(got) == {1, 3}
    assert got[1].text == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx y<|im_end|></s>"
    assert tuple(preprocess_summary(corpus, params).first()) == (2, ["en", "fr"], 2, 42)


def test_parameters():
    assert PrepareParams.from_mapping({"sample_size": "none"}).sample_size is None
    assert PrepareParams.from_mapping({"sample_size": "32"}).sample_size == 32
    for bad in ({"sample_size": 0}, {"filter_langs": []}, {"filter_langs": " , "}):
        with pytest.raises(ParameterError):
            PrepareParams.from_mapping(bad)


@pytest.mark.parametrize("parts", PARTS)
def test_unigram_scores(spark, parts):
    train = [(i, "the the the cat sat" if i % 2 else "the dog ran") for i in range(40)]
    texts = [(1, "the cat flew"), (2, "the"), (3, ""), (4, "dog dog")]
    counts = {}
    for _, text in train:
        for token in text.split():
            counts[token] = counts.get(token, 0) + 1
    size = sum(counts.values()) + len(counts) + 1
    vocab = scoring.vocabulary(spark.createDataFrame(train, "id long, text string").repartition(parts))
    scores = scoring.unigram_scores(spark.createDataFrame(texts, "id long, text string").repartition(parts), vocab, "id")
    got = {r.id: (r.n_tokens, r.loss) for r in scores.collect()}
    cost = lambda t: math.log(size / (counts.get(t, 0) + 1))
    assert set(got) == {1, 2, 4} and got[2] == (1, None)
    assert got[1][1] == pytest.approx((cost("cat") + cost("flew")) / 2)
    total = scoring.perplexity(scores).first()
    assert total.perplexity == pytest.approx(math.exp((got[1][1] * 3 + got[4][1] * 2) / 5))
    assert (total.n_tokens, total.n_texts, total.n_unscored) == (5, 2, 1)


def test_rare_and_frequent_tokens_score_alike(spark, monkeypatch):
    train = spark.createDataFrame([(1, "a a a b c")], "id long, text string")
    loss = []
    for limit in (10_000, 2):
        monkeypatch.setattr(scoring, "FREQUENT", limit)
        scores = scoring.unigram_scores(train, scoring.vocabulary(train), "id")
        loss.append(scores.first().loss)
    assert loss[0] == pytest.approx(loss[1])


def test_perplexity_without_tokens(spark):
    assert scoring.perplexity(spark.createDataFrame([], "id long, n_tokens long, loss double")).first().perplexity is None


def test_trigrams_are_whole(one):
    grams = language.trigrams(language.words(F.col("t")))
    assert one(grams, t="Ab, éc1d") == ["_ab", "ab_", "_éc", "éc_", "_d_"]
    assert one(F.size(grams), t="x" * 100_000) == 100_000


def test_detect_language(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr")]
    corpus = spark.createDataFrame(rows, "id long, text string, lang string")
    profile = language.language_profile(corpus, ["en", "fr"])
    texts = spark.createDataFrame([(1, "the dog"), (2, "chien et chat"), (3, "1234"), (4, "")], "id long, text string")
    found = {r.id: r.language for r in language.detect_language(texts, profile, ["en", "fr"], ["id"]).collect()}
    assert found == {1: "en", 2: "fr", 3: "unknown", 4: "unknown"}


@pytest.mark.parametrize(
    "found, want, passes, strict",
    [("es", "en", True, False), ("fr", "EN", False, False), ("en", "EN", True, True), ("unknown", "ur", True, False), ("fr", "", True, True)],
)
def test_language_pass(one, found, want, passes, strict):
    assert one(evaluation.language_pass(F.col("f"), F.col("w"), False), f=found, w=want) is passes
    assert one(evaluation.language_pass(F.col("f"), F.col("w"), True), f=found, w=want) is strict


@pytest.mark.parametrize("text, limit, passes", [("a. b..", 2, True), ("a. b. c", 2, False), ("a.b", 0, True), ("", 1, True), ("a! b? c", 1, True)])
def test_length_pass(one, text, limit, passes):
    assert one(evaluation.length_pass(F.col("t"), F.col("n")), t=text, n=limit) is passes


def test_generate_streams_batches(spark):
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(50)], "id long, prompt_text string")

    def model(prompts):
        for batch in prompts:
            yield batch.str.upper() + " "

    assert all(r.generation == f"P{r.id}" for r in evaluation.generate(rows, model).collect())


def test_plugged_tokenizer(spark):
    class Characters:
        """A tokenizer of one id per character."""

        def encode(self, text):
            return [ord(c) for c in text]

        def decode(self, ids):
            return "".join(map(chr, ids))

    rows = [(1, "a", "", "x y", "en"), (2, "b", "", "é" * 200, "en")]
    corpus = spark.createDataFrame(rows, "id long, instruction string, input string, output string, lang string")
    params = PrepareParams(sample_size=None, cutoff_len=90, eos="")
    got = {r.id: r for r in prepare_instructions(corpus, params, Characters).collect()}
    assert (got[1].was_cut, got[1].n_tokens) == (False, len(got[1].text))
    assert (got[2].was_cut, got[2].n_tokens, len(got[2].text)) == (True, 90, 90)
    encoded = corpus.select("id", token_ids(F.col("output"), Characters).alias("ids"))
    blocks = packing.pack_blocks(encoded, 10, "id", 3, eos=0, ids="ids").orderBy("chunk_id").collect()
    stream = []
    for key in sorted((1, 2), key=lambda k: order("pack", k)):
        stream += Characters().encode(rows[key - 1][3]) + [0]
    assert [t for b in blocks for t in b.tokens] == stream[: len(stream) // 10 * 10]


def test_blocks_cut_one_long_document_whole(spark):
    words = [f"w{i}" for i in range(5000)]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "")], "id long, text string")
    blocks = packing.pack_blocks(rows, 100, "id", 3).orderBy("chunk_id").collect()
    got = [t for b in blocks for t in b.tokens if t != "<eos>"]
    assert len(blocks) == 50 and all(b.n_tokens == 100 for b in blocks)
    assert got == words[: len(got)] and len(got) >= 4998
    stats = packing.pack_stats(rows, 100, "id", seed=3).first()
    assert (stats.n_docs, stats.n_tokens, stats.n_blocks, stats.dropped_tokens) == (3, 5002, 50, 2)


def test_unigram_scores_count_repeats_and_unseen_tokens(spark):
    vocab = scoring.vocabulary(spark.createDataFrame([("a a a b",)], "text string"))
    rows = spark.createDataFrame([(i, "x new new a new") for i in range(40)] + [(99, "one"), (100, "")], "id long, text string")
    got = {r.id: (r.n_tokens, r.loss) for r in scoring.unigram_scores(rows, vocab, "id").collect()}
    new, a = math.log(7) - math.log(1), math.log(7) - math.log(4)
    assert set(got) == {*range(40), 99} and got[99] == (1, None)
    assert all(got[i][0] == 5 and abs(got[i][1] - (3 * new + a) / 4) < 1e-9 for i in range(40))


def test_chat_preparation_filters_samples_and_plugs_in_a_tokenizer(spark):
    rows = [(c, t, ("user", "assistant")[t], f"c{c} t{t}", ("en", "de")[c % 2]) for c in range(50) for t in range(2)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, lang string")
    params = PrepareParams(sample_size=3, languages=["en"], eos="")
    got = {r.conv_id for r in prepare_chat(turns, params).collect()}
    assert got == set(sorted(range(0, 50, 2), key=lambda k: order("sample", k, 42))[:3])

    class Letters:
        def encode(self, text):
            return [ord(c) for c in text]

        def decode(self, ids):
            return "".join(map(chr, ids))

    assert {r.conv_id for r in prepare_chat(turns, params, Letters).collect()} == got
    with pytest.raises(ValueError, match="no column lang"):
        prepare_chat(turns.drop("lang"), params)


def test_a_corpus_without_languages_is_refused_by_the_filter(spark):
    source = spark.createDataFrame([(1, "a", "b")], "id long, instruction string, output string")
    corpus = read_instructions(source, {"id": "id", "instruction": "instruction", "output": "output"})
    with pytest.raises(ValueError, match="no column lang"):
        prepare_instructions(corpus, PrepareParams(sample_size=None))
    free = PrepareParams(sample_size=None, languages=None)
    assert prepare_instructions(corpus, free).count() == 1
    assert tuple(preprocess_summary(corpus, free).first()) == (1, [], 0, 42)
