"""Licence scan: texts compared to licence templates by the Dice coefficient over word bigrams.

A text is normalised to lower-case words. Notices are whole lines, and windows of words
anywhere in the text, across line ends too, whose distinct bigrams reach the wanted
coefficient with a template. Only texts with an anchor are taken apart: a match shares so many bigrams
with its template that it holds one of the template's anchors. All of it is
DataFrame expressions over one row at a time; the templates are literals.

A window has at most the template's number of bigrams divided by t / (2 - t). It has just the template's
number and begins with one of its bigrams (or ends with the text), or more and begins and ends with one, or it
is a stretch of whole lines, which may be shorter. Of a template's windows that share a word the one with the
largest coefficient counts, then the one that shares more bigrams, then the first. Of these and of whole lines, where
they share a word, the one that shares more bigrams with its template counts, then the
whole line, then the larger coefficient.

Defined results: null and empty texts, and texts without a bigram, match
nothing; of templates that fit a line equally well the first by name counts;
rows with equal ids are taken together, and a null id is an id like any other;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Licence notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    ),
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def all_bigrams_of(text: str) -> list[str]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def bigrams_of(text: str) -> list[str]:
    """The same bigrams of a template, made on the driver."""
    return list(dict.fromkeys(all_bigrams_of(text)))


def least_shared(n: int, ratio: float) -> int:
    """Bigrams that any match shares with a template of `n`: 2 * overlap >= t * (a + b) and b >= overlap."""
    return max(1, math.ceil(n * ratio - 1e-9))


def anchor_pattern(known: dict[str, list[str]], ratio: float) -> str:
    """Found in every text with a match: of each template so many bigrams, those of long words, that a match cannot lack them all."""
    by_letter: dict[str, set[str]] = {}
    for pairs in known.values():
        rare = sorted(pairs, key=lambda p: (-min(map(len, p.split())), -len(p), p))
        for pair in rare[: len(pairs) - least_shared(len(pairs), ratio) + 1]:
            spelt = ["".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in pair.split()]
            by_letter.setdefault(spelt[0][: 4 if spelt[0][0] == "[" else 1], set()).add("[^A-Za-z0-9]+".join(spelt))
    grouped = (f"{first}(?:{'|'.join(sorted(x[len(first) :] for x in rest))})" for first, rest in sorted(by_letter.items()))
    return f"(?<![A-Za-z0-9])(?:{'|'.join(grouped)})(?![A-Za-z0-9])"


def words_of(line: Column) -> Column:
    plain = F.regexp_replace(F.translate(line, UPPER, LOWER), "[^a-z0-9]+", " ")
    return F.split(F.trim(plain), " ")


def bigrams(words: Column) -> Column:
    """Pairs of neighbouring words; none for fewer than two words."""
    return F.transform(
        F.slice(words, 2, F.size(words)), lambda word, i: F.concat_ws(" ", F.element_at(words, (i + 1).cast("int")), word)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def apart(ranked: Column, kind: str) -> Column:
    """Those of the ranked stretches (fields `at` and `to`, first and last word) that share no word with a better one."""

    def add(kept: Column, x: Column) -> Column:
        meets = F.exists(kept, lambda y: (y["at"] <= x["to"]) & (x["at"] <= y["to"]))
        return F.when(meets, kept).otherwise(F.concat(kept, F.array(x)))

    return F.aggregate(ranked, F.array().cast(kind), add)


def scan(docs: DataFrame, templates: dict[str, str], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, n_lines (notices), first_line (from 0, of the first notice) and dice (the largest) of each licence found in a document."""
    known = {name: bigrams_of(text) for name, text in sorted(templates.items())}
    known = {name: pairs for name, pairs in known.items() if pairs}
    sizes = [len(p) for p in known.values()]
    # 2 * overlap / (a + b) >= t needs b between t / (2 - t) * a and its inverse.
    ratio = threshold / (2 - threshold)
    low, high = min(sizes) * ratio, max(sizes) / ratio
    literals = F.array(
        *[
            F.struct(
                F.lit(name).alias("license"),
                F.array(*map(F.lit, pairs)).alias("pairs"),
                F.lit(least_shared(len(pairs), ratio)).alias("least"),
                F.lit(len(all_bigrams_of(templates[name]))).alias("length"),
                F.lit(int(len(all_bigrams_of(templates[name])) / ratio + 1e-9)).alias("most"),
            )
            for name, pairs in known.items()
        ]
    )
    # Each step is exploded from an array of one: Spark then computes it once instead of once for each use.
    texts = docs.where(F.col("text").rlike(anchor_pattern(known, ratio)))
    texts = texts.select("doc_id", F.explode(F.array(F.transform(F.split("text", "\n"), words_of))).alias("lines"))
    filled = F.filter(
        F.transform("lines", lambda words, i: F.struct(i.alias("line"), F.filter(words, lambda w: w != "").alias("words"))),
        lambda x: F.size(x["words"]) > 0,
    )
    texts = texts.select("doc_id", F.explode(F.array(filled)).alias("lines"))
    words = F.flatten(F.transform("lines", lambda x: x["words"]))
    texts = texts.select("doc_id", "lines", F.explode(F.array(words)).alias("words"))
    texts = texts.select("doc_id", "lines", F.explode(F.array(bigrams(F.col("words")))).alias("pairs"))
    texts = texts.where(F.size("pairs") > 0)
    # Places, from 1, of bigrams of any template.
    some = sorted({p for pairs in known.values() for p in pairs})
    hits = F.filter(F.sequence(F.lit(1), F.size("pairs")), lambda i: F.element_at("pairs", i).isin(some))
    texts = texts.select("*", F.explode(F.array(hits)).alias("hits")).where(F.size("hits") > 0)
    # Of each word its line, its place there from 0 and the number of words there; of each line its first word.
    places = F.flatten(
        F.transform(
            "lines",
            lambda x: F.transform(
                x["words"], lambda _, k: F.struct(x["line"].alias("line"), k.alias("k"), F.size(x["words"]).alias("n"))
            ),
        )
    )
    texts = texts.select("*", F.explode(F.array(places)).alias("places"))
    firsts = F.filter(F.sequence(F.lit(1), F.size("places")), lambda i: F.element_at("places", i)["k"] == 0)
    texts = texts.select("*", F.explode(F.array(firsts)).alias("firsts"))

    def dice(shared: Column, a: Column, b: Column) -> Column:
        return 2.0 * shared / (a + b)

    # Windows: rank fields first. `at` and `to` are places of words, from 1.
    window = "struct<less_dice:double,less_shared:int,at:int,to:int>"

    def window_of(t: Column, at: Column, to: Column) -> Column:
        inside = F.slice("pairs", at, to - at + 1)
        shared = F.size(F.array_intersect(inside, t["pairs"]))
        return F.struct(
            (-dice(shared, F.size(t["pairs"]), F.size(F.array_distinct(inside)))).alias("less_dice"),
            (-shared).alias("less_shared"),
            at.alias("at"),
            (to + 1).alias("to"),
        )

    def windows_from(t: Column, own: Column, at: Column, k: Column) -> Column:
        """The fitting windows of a template at the k-th of its places."""
        ends = F.filter(F.slice(own, k + t["least"] - 1, t["most"]), lambda to: to < at + t["most"])
        last = F.size("pairs")
        start = F.least(at, F.greatest(F.lit(1), last - t["length"] + 1))
        stretches = F.concat(
            F.array(F.struct(start.alias("at"), F.least(start + t["length"] - 1, last).alias("to"))),
            F.transform(F.filter(ends, lambda to: to >= at + t["length"]), lambda to: F.struct(at.alias("at"), to.alias("to"))),
            F.filter(
                F.transform(
                    ends,
                    lambda to: F.struct(
                        (at - F.element_at("places", at)["k"]).alias("at"),
                        (to - 1 + F.element_at("places", to + 1)["n"] - F.element_at("places", to + 1)["k"]).alias("to"),
                    ),
                ),
                lambda x: x["to"] - x["at"] < t["most"],
            ),
        )
        found = F.transform(F.array_distinct(stretches), lambda x: window_of(t, x["at"], x["to"]))
        none = F.array().cast(f"array<{window}>")
        return F.when(F.size(ends) > 0, F.filter(found, lambda x: x["less_dice"] <= -threshold)).otherwise(none)

    def windows(t: Column) -> Column:
        own = F.filter("hits", lambda i: F.array_contains(t["pairs"], F.element_at("pairs", i)))
        found = let(own, lambda own: F.flatten(F.transform(own, lambda at, k: windows_from(t, own, at, k + 1))))
        return apart(F.array_sort(F.array_distinct(found)), f"array<{window}>")

    # Lines and windows together, the rank fields first again.
    def whole(line: Column) -> Column:
        b = F.size(line["pairs"])

        def score(t: Column, i: Column) -> Column:
            a = F.size(t["pairs"])
            return let(
                F.size(F.array_intersect(line["pairs"], t["pairs"])),
                lambda shared: F.struct(
                    F.when(b.between(a * ratio, a / ratio), dice(shared, a, b)).otherwise(0.0).alias("dice"),
                    (-i).alias("order"),
                    shared.alias("shared"),
                    t["license"].alias("license"),
                ),
            )

        scores = F.transform(literals, score)
        return let(F.array_max(scores), lambda s: notice(s["shared"], 0, s["dice"], s["license"], line["at"], line["at"] + line["n"] - 1))

    def notice(shared: Column, order: int, dice: Column, license: Column, at: Column, to: Column) -> Column:
        return F.struct(
            (-shared).alias("less_shared"),
            F.lit(order).alias("order"),
            (-dice).alias("less_dice"),
            license.alias("license"),
            at.cast("int").alias("at"),
            to.cast("int").alias("to"),
        )

    fitting = F.transform(
        "lines",
        lambda x, i: F.struct(
            F.element_at("firsts", i + 1).alias("at"),
            F.size(x["words"]).alias("n"),
            F.array_distinct(bigrams(x["words"])).alias("pairs"),
        ),
    )
    fitting = F.filter(fitting, lambda x: F.size(x["pairs"]).between(low, high))
    lines = F.filter(F.transform(fitting, whole), lambda x: x["less_dice"] <= -threshold)
    others = F.flatten(
        F.transform(
            literals,
            lambda t: F.transform(
                windows(t), lambda w: notice(-w["less_shared"], 1, -w["less_dice"], t["license"], w["at"], w["to"])
            ),
        )
    )
    kind = "array<struct<less_shared:int,order:int,less_dice:double,license:string,at:int,to:int>>"
    found = texts.select("doc_id", "places", F.explode(F.array(F.array_sort(F.concat(lines, others)))).alias("ranked"))
    best = found.where(F.size("ranked") > 0).select("doc_id", "places", F.explode(apart(F.col("ranked"), kind)).alias("b"))
    line = F.element_at("places", F.col("b.at"))["line"].alias("line")
    best = best.select("doc_id", F.col("b.license").alias("license"), line, "b.less_dice")
    return best.groupBy("doc_id", "license").agg(
        F.count("*").alias("n_lines"), F.min("line").alias("first_line"), F.max(-F.col("less_dice")).alias("dice")
    )
