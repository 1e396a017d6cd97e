"""Joins, searches and filters against brute force and SQL, and the pipeline stage by stage."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from tuneweave.llm import ann, license_scan, ngram_join, url_filter
from tuneweave.llm.components import components
from tuneweave.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert compare.difference(spark, compare.duck(FOLDER), FOLDER, QUERIES[name], ORACLE[name]) is None


def brute_components(docs, size, percent):
    sets = {}
    for key, text in docs:
        words = (text or "").encode().lower().split()
        sets[key] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    top = {k: k for k in sets}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                a_, b_ = find(a), find(b)
                top[max(a_, b_)] = min(a_, b_)
    return {k: (len(sets[k]), find(k)) for k in keys}


def copies(seed, percent):
    """Copies and near copies around the limit, a chain, boilerplate, short and empty texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    common = [word() for _ in range(30)]
    texts = [None, "", " \n", "one", "One", "one two", "one  two", "a b c", "A B C", "a b c a b c a b c"]
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(5, 120))] + common
        texts.append(" ".join(base))
        for _ in range(rnd.randint(1, 7)):
            other = list(base)
            for _ in range(rnd.randint(0, max(1, len(other) // 40))):
                other[rnd.randrange(len(other))] = word()
            base = other if rnd.random() < 0.5 else base
            texts.append(" ".join(other))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("size", "percent", "share", "block"), [(3, 90, 2.0**-16, None), (5, 80, 2.0**-16, None), (3, 80, 0.002, 2)])
def test_ngram_join_equals_brute_force(spark, monkeypatch, size, percent, share, block):
    if block:
        monkeypatch.setattr(ngram_join, "LONGEST_BLOCK", block)
    docs = copies(size * percent, percent)
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as fp").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(table, size, percent, share).collect()}
    assert got == brute_components(docs, size, percent)


def test_ngram_join_of_null_ids_repeats_and_nothing(spark):
    text = "a b c d e f g h"
    table = spark.createDataFrame([(None, text), (5, text), (5, text), (7, text), (8, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.join(table, 3, 90).collect()), key=str)
    assert got == [(5, 5), (5, 5), (7, 5), (8, 8), (None, None)]
    assert ngram_join.join(table.limit(0), 3, 90).collect() == []


def test_tree_walk_loses_no_pair():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 2**63, 400).astype(np.uint64)
    sets = []
    for n in rnd.integers(20, 400, 90):
        own = np.r_[base[:n], rnd.integers(0, 2**63, int(rnd.integers(0, 60))).astype(np.uint64)]
        sets.append(np.unique(own))
    sets.sort(key=len)
    members = [(bytes([i]), bytes([i]), len(s), ngram_join.signature(s), s) for i, s in enumerate(sets)]
    for groups in ([members], [members[:40], members[40:]]):
        i, j, _ = ngram_join.open_pairs(groups, 80)
        left = set(zip(i.tolist(), j.tolist()))
        for a in range(len(sets)):
            for b in range(a + 1, len(sets)):
                if ngram_join.linked(sets[a], sets[b], 80) and (len(groups) == 1 or a < 40 <= b):
                    assert (a, b) in left
        assert len(left) < len(sets) * (len(sets) - 1) / 2


def test_tree_walk_prunes_as_sharply_beside_a_much_longer_set():
    rnd = np.random.default_rng(2)
    sets = [np.unique(rnd.integers(0, 2**63, n).astype(np.uint64)) for n in [*[200] * 30, 20_000]]
    members = [(bytes([i]), bytes([i]), len(s), ngram_join.signature(s), s) for i, s in enumerate(sets)]
    for groups in ([members], [members[:10], members[10:]]):
        assert len(ngram_join.open_pairs(groups, 90)[0]) == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(7, 7), (1, 0)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 130)}}


def test_ann_recall_on_clustered_vectors(spark):
    rnd = np.random.default_rng(3)
    x = rnd.standard_normal((40, 16))[rnd.integers(0, 40, 3000)] + 0.3 * rnd.standard_normal((3000, 16))
    x[100:400] = x[100]  # a very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (5004, [1.0]), (None, x[0].tolist()), (0, x[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 3000, 20):
        scores = (x * x[q]).sum(axis=1)
        scores[q] = -np.inf
        true = np.lexsort((np.arange(3000), -scores))[:20]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(true.tolist()))
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
    assert sorted(got) == list(range(0, 3000, 20)) and hits / (150 * 20) >= 0.9


def test_ann_small_and_empty(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    rows = ann.search(table, F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(rows, key=lambda r: r["rank"])] == [(0, 1, 1, 1.0), (0, 2, 3, 0.0)]
    assert ann.search(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_url_edge_cases(spark):
    rules = [url_filter.host_rule("a.com/x/", "block"), url_filter.host_rule("com/", "allow"), *url_filter.WORDS]
    urls = ["http://A.com/x/1", "http://b.a.com/x/?q", "http://ba.com/x/1", "http://a.com", "ftp://casino-x.org/#/x/", "a.com/x/", None, "", "x://http://a.com/x/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'old' as Host")
    out = url_filter.filter_urls(pages, rules).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in out] == [
        ("a.com/x/", "block"), ("a.com/x/", "block"), ("com/", "allow"), (None, "allow"), (None, "block"),
        (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
    ]
    assert (out[0].host, out[0].path, out[3].path, out[6].host) == ("a.com", "/x/1", "", "")
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


def test_license_edge_cases(spark):
    texts = [None, "", "x", "All  rights, RESERVED\nall rights reserved", "Released under the MIT Licence.", "word " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = license_scan.scan(docs, license_scan.TEMPLATES).collect()
    assert [(r.doc_id, r.license, r.n_lines, r.first_line, r.dice) for r in rows] == [(3, "all-rights-reserved", 2, 0, 1.0)]
    plan = license_scan.scan(docs, license_scan.TEMPLATES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def brute_notices(text, templates, t):
    """license, first line and dice of each notice, by trying every window of every template."""
    norm = lambda x: "".join(c if c.isascii() and c.isalnum() else " " for c in x.lower()).split()
    words, line_of, found = [], [], []
    lines, ratio = (text or "").split("\n"), t / (2 - t)
    known = {n: [f"{a} {b}" for a, b in zip(norm(x), norm(x)[1:])] for n, x in sorted(templates.items())}
    for k, line in enumerate(lines):
        own = norm(line)
        pairs = set(map(" ".join, zip(own, own[1:])))
        fits = [(2 * len(pairs & set(p)) / (len(pairs) + len(set(p))), -i, n) for i, (n, p) in enumerate(known.items()) if len(set(p)) * ratio <= len(pairs) <= len(set(p)) / ratio]
        dice, _, name = max(fits, default=(0, 0, None))
        if dice >= t:
            found.append((-len(pairs & set(known[name])), 0, -dice, name, len(words), len(words) + len(own) - 1))
        words += own
        line_of += [k] * len(own)
    pairs = list(map(" ".join, zip(words, words[1:])))
    starts = [i for i in range(len(words)) if i == 0 or line_of[i] != line_of[i - 1]]
    stops = [*[i - 1 for i in starts[1:]], len(words) - 1]
    for name, p in known.items():
        length, p, own = len(p), set(p), []
        most, last = int(length * (2 - t) / t + 1e-9), len(pairs) - 1
        places = [i for i, x in enumerate(pairs) if x in p]
        tried = {(i, min(i + length - 1, last)) for i in (max(0, min(i, last - length + 1)) for i in places)}
        tried |= {(i, j) for i in places for j in places if length < j - i + 1 <= most}
        tried |= {(i, j - 1) for i in starts for j in stops if 1 <= j - i <= most}
        for i, j in tried:
            inside = set(pairs[i : j + 1])
            dice = 2 * len(inside & p) / (len(inside) + len(p))
            if dice >= t:
                own.append((-dice, -len(inside & p), i, j + 1))
        kept = []
        for x in sorted(own):
            if not any(y[2] <= x[3] and x[2] <= y[3] for y in kept):
                kept.append(x)
        found += [(x[1], 1, x[0], name, x[2], x[3]) for x in kept]
    kept = []
    for x in sorted(found):
        if not any(y[4] <= x[5] and x[4] <= y[5] for y in kept):
            kept.append(x)
    out = {}
    for _, _, less, name, start, _ in kept:
        n, first, dice = out.get(name, (0, 1 << 30, 0))
        out[name] = (n + 1, min(first, line_of[start]), max(dice, -less))
    return out


def test_license_notices_wrapped_and_inside_lines_against_brute_force(spark):
    rnd = random.Random(4)
    known = license_scan.TEMPLATES
    texts = ["Copyright 2024 X Y. Released under the MIT License.", "x\n" + known["apache-2.0-notice"].replace(" you may", "\n# you may")]
    for name, notice in known.items():
        for _ in range(4):
            words = notice.split()
            for _ in range(rnd.randint(0, max(1, len(words) // 8))):
                words[rnd.randrange(len(words))] = rnd.choice(["of", "the", "x", "x y", ""])
            lead = [rnd.choice("some words of the text under License rights".split()) for _ in range(rnd.randint(0, 9))]
            words = lead + words + rnd.choice([[], ["All", "rights", "reserved."], notice.split(), ["the", "end"]])
            texts.append("".join(w + rnd.choice([" ", " ", " ", " ", "\n", "\n * "]) for w in words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {}
    for r in license_scan.scan(docs, known).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.n_lines, r.first_line, r.dice)
    assert got[0] == {"mit": (1, 0, 1.0)} and got[1] == {"apache-2.0-notice": (1, 1, 1.0)}
    assert got == {i: found for i, x in enumerate(texts) if (found := brute_notices(x, known, license_scan.THRESHOLD))}


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("kept", F.lit("mine")).withColumn("score", F.lit(1))
    (_, rules), (_, language), (_, near), (_, pack) = corpus_pipeline.STAGES
    first = rules(spark, docs, FOLDER).cache()
    second = language(spark, first, FOLDER).cache()
    assert first.columns == second.columns == docs.columns
    third = near(spark, second, FOLDER).cache()
    want = brute_components([(r.doc_id, r.text) for r in second.collect()], 5, 80)
    assert sorted(r.doc_id for r in third.collect()) == sorted(k for k, (_, c) in want.items() if c == k)
    assert third.columns == docs.columns
    assert {r.doc_id for r in pack(spark, third, FOLDER).collect()} == {r.doc_id for r in third.collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    lost = good - {r.doc_id for r in second.collect()}
    assert len(lost) <= 0.05 * len(good)


def test_pipeline_on_nulls(spark):
    docs = spark.createDataFrame([(1, None), (None, "a b c d e f g h i j k"), (2, "a b c d e f g h i j k"), (2, "a b c d e f g h i j k")], "doc_id long, text string")
    out = corpus_pipeline.near_duplicate_stage(spark, docs, FOLDER).collect()
    assert sorted((str(r.doc_id) for r in out)) == ["1", "2", "None"]
