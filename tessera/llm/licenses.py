"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line of the text, or a block of lines up to one without a letter or digit (so that
bare comment marks end it), which finds notices that are wrapped.  Its features are the word 1-grams (of five letters or more) and
2-grams that occur in some licence template.  A multinomial logistic regression gives each paragraph
a family or ``unknown``; it is fitted on templates with words left out or run into other text, and on
a bounded sample of the corpus's own lines as ``unknown``: some that speak of no licence, and some that
do but hold little of any template.  The sample goes by a hash of document, line number and text, so
the files that hold the documents do not matter.  A temperature fitted on other variants and
lines calibrates its chances.  A predicted family is confirmed where the paragraph holds most n-grams
of one of the family's templates.

Paragraphs are scored by a join of their n-grams with the weight table (bounded by the templates, so
broadcast) and a pre-aggregated sum; only DataFrame functions and ML transformers of Spark are used.
Texts and paragraphs that cannot reach any family are left out before (:func:`needed_grams`): the
weights of all n-grams that they may hold together do not outweigh the bias of ``unknown``.

Defined results: NULL and empty texts and lines have no paragraph; repeated rows each have their own
results; NULL ids are kept; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.rules import let
from tessera.llm.words import least_hashes, need

UNKNOWN = "unknown"
#: Corpus lines that stand for ``unknown`` in fitting and as many in calibration, at most.
SAMPLE = 2_000
#: Characters of such a line, at most.
LONGEST = 1_000
#: Lines that speak of a licence, and the share of any template's n-grams below which they stand for
#: ``unknown`` too (half as many as ``SAMPLE``, at most).
SPEAKS, LITTLE = "licen[sc]|copyright|spdx", 0.3
#: Least chance of a reported family, and least share of a template's n-grams that confirms it.
CHANCE, CONFIRM = 0.5, 0.6

#: Comment marks that hold letters, at the start of a line (all others part words anyhow).
COMMENT = r"(?i)^\s*(?:dnl|rem)(?=\s)"

# Notices and opening paragraphs of licences, as their publishers word them.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied.",
        "SPDX-License-Identifier: Apache-2.0"],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT"],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only"],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License."],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License."],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights "
        "to this work.", "SPDX-License-Identifier: CC0-1.0"],
}
#: Sentences of contracts and notices that name no licence.
OTHER = [
    "All rights reserved.", "Copyright by the authors.", "The licence fee is due each year.",
    "Please read the terms of use before you go on.", "The software is provided by the vendor.",
    "A driving licence is required.", "This work is under review.", "Version 3 was released today.",
    "Licensed premises close at ten.", "The general public is welcome.", "Released under a new name.",
    "You may not use this file.", "Permission is required to publish.", "Free of charge for members.",
    "This project is under construction.", "Distributed to any person at the door."]


def tokens(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), "[^a-z0-9]+"), "")


def grams(line: Column) -> Column:
    """Distinct 1-grams of five letters or more, and 2-grams."""
    def of(w: Column) -> Column:
        pairs = F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                            lambda x, i: F.concat_ws(" ", F.get(w, i), x))
        return F.array_distinct(F.concat(F.filter(w, lambda x: F.length(x) >= 5), pairs))
    return let(tokens(line), of)


def paragraphs(docs: DataFrame) -> DataFrame:
    """``uid, doc_id, line, text``: lines of texts; ``uid`` tells rows of one scan apart."""
    return (docs.select(F.monotonically_increasing_id().alias("uid"),
                        F.col("doc_id").cast("long").alias("doc_id"),
                        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n"))
                        .alias("line", "text")).where(F.col("text").rlike("[A-Za-z0-9]")))


def blocks(docs: DataFrame) -> DataFrame:
    """``uid, doc_id, first, line, whole, text``: the lines of :func:`paragraphs`, each with the first
    line of its block, and beside them every block of two lines or more (``whole``), as one text."""
    def spans(full: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(full) - 1)

        def edge(step: int) -> Column:
            return F.filter(at, lambda i: F.get(full, i) & ~F.coalesce(F.get(full, i + step),
                                                                       F.lit(False)))
        return F.zip_with(edge(-1), edge(1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def parts(first: Column, lines: Column) -> Column:
        def part(line: Column, whole: bool, text: Column) -> Column:
            return F.struct(line.alias("line"), F.lit(whole).alias("whole"), text.alias("text"))
        own = F.transform(lines, lambda x, i: part(first + i, False, x))
        bare = F.transform(lines, lambda x: F.regexp_replace(x, COMMENT, ""))
        return F.when(F.size(lines) < 2, own).otherwise(
            F.concat(own, F.array(part(first, True, F.array_join(bare, "\n")))))

    def of_lines(lines: Column) -> Column:
        full = F.transform(lines, lambda x: x.rlike("[A-Za-z0-9]"))
        return F.transform(let(full, spans), lambda s: F.struct(
            s["a"].alias("first"), F.slice(lines, s["a"] + 1, s["b"] - s["a"] + 1).alias("lines")))

    found = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.explode(let(F.split(F.coalesce("text", F.lit("")), "\n"), of_lines)).alias("block"))
    return found.select("uid", "doc_id", F.col("block.first").alias("first"), F.inline(
        parts(F.col("block.first"), F.col("block.lines"))))


def variants(templates: Mapping[str, Sequence[str]], seed: int,
             rounds: int = 12) -> list[tuple[str, str]]:
    """``(family, paragraph)``: templates as they are, with words left out, and run into words that
    belong to no template."""
    rng = random.Random(seed)
    out = []
    for family, texts in templates.items():
        for text in texts:
            out.append((family, text))
            for _ in range(rounds):
                words = [w for w in text.split() if rng.random() > 0.08]
                pads = [["".join(rng.choices("abdehiklmnorstu", k=rng.randint(2, 9)))
                         for _ in range(rng.choice((0, 0, 3, 12)))] for _ in range(2)]
                out.append((family, " ".join(pads[0] + words + pads[1])))
    return out


@dataclass
class Model:
    """``weights``: ``gram, gid, w`` (one weight per class); ``templates``: ``gid, template``."""

    classes: list[str]
    intercepts: list[float]
    temperature: float
    weights: DataFrame
    templates: DataFrame
    sizes: DataFrame
    pattern: str | None = None


def _template_grams(spark: SparkSession, templates: Mapping[str, Sequence[str]]) -> DataFrame:
    rows = [(f, i, t) for i, (f, t) in enumerate((f, t) for f, ts in templates.items() for t in ts)]
    return spark.createDataFrame(rows, "family string, template int, text string").select(
        "family", "template", F.explode(grams(F.col("text"))).alias("gram"))


def _logits(rows: DataFrame, weights: DataFrame, intercepts: Sequence[float], *keys: str) -> DataFrame:
    """``keys, gids, z`` (one logit per class) of paragraphs that hold a known n-gram."""
    hits = rows.select(*keys, F.explode(grams(F.col("text"))).alias("gram")).join(
        F.broadcast(weights), "gram")  # the templates bound the weight table
    sums = [(F.sum(F.col("w")[k]) + F.lit(float(b))) for k, b in enumerate(intercepts)]
    return hits.groupBy(*keys).agg(F.collect_set("gid").alias("gids"), F.array(*sums).alias("z"))


def _chances(z: Column, temperature: float) -> Column:
    scaled = F.transform(z, lambda x: x / F.lit(temperature))
    powers = let(scaled, lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))
    return let(powers, lambda p: F.transform(p, lambda x: x / F.aggregate(
        p, F.lit(0.0), lambda a, y: a + y)))


def fit(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES,
        sample: int = SAMPLE) -> Model:
    """Fit on variants of the templates and on at most ``3 * sample`` lines of the corpus, of at most
    ``LONGEST`` characters, those with the smallest hashes: two thirds speak of no licence or
    copyright, a third does but holds little of any template."""
    spark = docs.sparkSession
    own = _template_grams(spark, templates)
    vocabulary = sorted({r.gram for r in own.select("gram").collect()})  # bounded by the templates
    classes = [*sorted(templates), UNKNOWN]
    short, speaks = F.length("text") <= LONGEST, F.lower("text").rlike(SPEAKS)
    plain = paragraphs(docs).where(short & ~speaks)
    hard = paragraphs(docs.where(speaks)).where(short & speaks & (_share(templates) < LITTLE))
    texts = [[r.text for r in least_hashes(lines, n, "doc_id", "line", "text").select("text").collect()]
             for lines, n in ((plain, 2 * sample), (hard, sample))]
    parts = []
    for seed, at in ((1, 0), (2, 1)):
        rows = [(float(classes.index(f)), t) for f, t in variants(templates, seed)]
        rows += [(float(len(classes) - 1), t) for lines in (*texts, OTHER * 8) for t in lines[at::2]]
        parts.append(spark.createDataFrame(rows, "label double, text string"))
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features", binary=True)
    learn = vectors.transform(parts[0].withColumn("grams", grams(F.col("text"))))
    fitted = LogisticRegression(family="multinomial", regParam=2e-3, elasticNetParam=0.2,
                                maxIter=60).fit(learn.coalesce(1))
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = spark.createDataFrame(
        [(g, i, [float(x) for x in matrix[:, i]]) for i, g in enumerate(vocabulary)],
        "gram string, gid int, w array<double>")
    temperature = _temperature(parts[1], weights, list(bias))
    common = {r.gram: r.n for r in parts[0].where(F.col("label") == len(classes) - 1).select(
        F.explode(grams(F.col("text"))).alias("gram")).join(F.broadcast(weights.select("gram")), "gram")
        .groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}  # bounded by the templates
    pattern = needed_grams(vocabulary, matrix, bias, common)
    keyed = own.join(weights.select("gram", "gid"), "gram").select("family", "template", "gid")
    sizes = keyed.groupBy("family", "template").agg(F.count(F.lit(1)).alias("size"))
    return Model(classes, [float(b) for b in bias], temperature, weights, keyed, sizes, pattern)


def _share(templates: Mapping[str, Sequence[str]]) -> Column:
    """Greatest share of a template's n-grams that the line ``text`` holds."""
    def gram_set(text: str) -> list[str]:
        words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
        return sorted({w for w in words if len(w) >= 5} | set(map(" ".join, zip(words, words[1:]))))
    sets = [g for ts in templates.values() for t in ts if (g := gram_set(t))]
    return let(grams(F.col("text")), lambda own: F.array_max(F.array(F.lit(0.0), *[
        F.size(F.array_intersect(own, F.array(*[F.lit(g) for g in s]))) / F.lit(float(len(s)))
        for s in sets])))


def needed_grams(vocabulary: Sequence[str], matrix: np.ndarray, bias: Sequence[float],
                 common: Mapping[str, int]) -> str | None:
    """Pattern of n-grams of which every paragraph with a predicted family holds one (to be looked for
    in a blank and the lower-cased paragraph), or None if there may be such without.

    A family beats ``unknown`` (the last class) only if the n-grams' weights for it, less those for
    ``unknown``, outweigh the difference of the biases.  The commonest n-grams whose gains together stay
    below that for every family are not needed; every other one is in the pattern.
    """
    gains = np.maximum(np.asarray(matrix)[:-1] - np.asarray(matrix)[-1], 0.0)
    left = float(bias[-1]) - np.asarray(bias, dtype=float)[:-1] - 1e-6
    if (left <= 0).any():
        return None
    needed = set()
    for i in sorted(range(len(vocabulary)), key=lambda i: (-common.get(vocabulary[i], 0), gains[:, i].max())):
        if (gains[:, i] < left).all():
            left = left - gains[:, i]
        else:
            needed.add(vocabulary[i])
    alone = sorted(g for g in needed if " " not in g)
    pairs = sorted(g for g in needed if " " in g and not needed & set(g.split()))
    # A comment mark may stand between the words of two lines.
    gap = "[^a-z0-9]+(?:(?:dnl|rem)[^a-z0-9]+)?"
    by_letter = [f"{c}(?:{'|'.join(g[1:].replace(' ', gap) for g in words)})"
                 for c, words in groupby(sorted(alone + pairs), key=lambda g: g[0])]
    return f"[^a-z0-9](?:{'|'.join(by_letter)})(?![a-z0-9])" if by_letter else "(?!)"


def _temperature(rows: DataFrame, weights: DataFrame, bias: list[float]) -> float:
    """Temperature of least log loss on paragraphs that the weights were not fitted on."""
    keyed = rows.withColumn("id", F.monotonically_increasing_id())
    z = _logits(keyed, weights, bias, "id", "label")
    grid = [0.25 * 1.25 ** k for k in range(16)]
    loss = [F.sum(-F.log(F.greatest(F.get(_chances(F.col("z"), t), F.col("label").cast("int")),
                                    F.lit(1e-12)))) for t in grid]
    values = z.agg(*[x.alias(f"l{i}") for i, x in enumerate(loss)]).first()
    return min((v if v is not None else math.inf, t) for v, t in zip(values, grid))[1]


def scan(docs: DataFrame, model: Model, chance: float = CHANCE, confirm: float = CONFIRM) -> DataFrame:
    """``doc_id, line, family, chance, share, confirmed`` of lines with a predicted family, and of
    blocks (by their first line) that confirm a family which none of their lines confirms."""
    need(docs, "doc_id", "text")
    names = F.array(*[F.lit(c) for c in model.classes])
    keys = ["uid", "doc_id", "first", "line", "whole"]
    able = (F.lit(True) if model.pattern is None
            else F.concat(F.lit(" "), F.lower("text")).rlike(model.pattern))
    z = _logits(blocks(docs.where(able)).where(able), model.weights, model.intercepts, *keys)
    best = z.withColumn("p", _chances(F.col("z"), model.temperature)).withColumn(
        "chance", F.array_max("p"))
    named = best.withColumn("family", F.get(names, (F.array_position("p", F.col("chance")) - 1)
                                            .cast("int")))
    found = named.where((F.col("family") != UNKNOWN) & (F.col("chance") >= chance)).drop("z", "p")
    shares = (found.select(*keys, "family", "chance", F.explode("gids").alias("gid"))
              .join(F.broadcast(model.templates), ["family", "gid"], "left")
              .groupBy(*keys, "family", "chance", "template")
              .agg(F.count("template").alias("n"))
              .join(F.broadcast(model.sizes), ["family", "template"], "left")
              .groupBy(*keys, "family", "chance")
              .agg(F.max(F.coalesce(F.col("n") / F.col("size"), F.lit(0.0))).alias("share")))
    own = F.max(~F.col("whole") & (F.col("share") >= confirm)).over(
        Window.partitionBy("uid", "first", "family"))
    told = shares.withColumn("own", own).where(
        ~F.col("whole") | ((F.col("share") >= confirm) & ~F.col("own")))
    return told.select("doc_id", F.col("line").cast("long").alias("line"), "family", "chance",
                         "share", (F.col("share") >= confirm).alias("confirmed"))
