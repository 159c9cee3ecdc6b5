"""Licence statements: a trained paragraph classifier, confirmed by templates.

Paragraphs are scored by a multinomial logistic regression over word n-grams (one to
three words), one class for each licence family and one for anything else. Its
vocabulary is that of the templates, so its weights are a small table; scoring is a
join with it and a sum. A prediction counts if its
probability reaches the cutoff; the rest is ``unknown``. The cutoff is set on the half
of the unknown class that the classifier is not fitted on (all parts of a text fall
into the same half): it lets at most ``MAX_MISTAKEN`` pass of its ordinary paragraphs,
and at most as many of its sentences with a cue that grant nothing, each by itself. A
prediction is confirmed if the paragraph holds enough of the word pairs, in order, of
one of the family's templates, the word that names the family included (a template
without such a word, like the opening of the MIT text, by its pairs alone).

The classifier is fitted on parts of the templates and on a bounded sample of
paragraphs without a cue (``sample_paragraphs``). Scoring covers every paragraph of
every text: each line by itself, and the joined lines of each block between blank
lines, for notices that are wrapped. Only those are left out early whose summed
positive weights cannot bring any family up to the unknown class (``_Bound``), and so
to no cutoff, as none is below a half.

A statement is a block of a known family none of whose lines is confirmed or of
another family by itself (its lines are then not counted), or else a line of a known
family or, as ``unknown``, a line with one of the cues. Cues name nothing but these unknown statements.

Defined results: a null text or one without a statement has no licence (null family,
score 0, no paragraphs); of several statements the most probable one names the family, ties
go to the name first in alphabetical order; repeated rows are answered alike; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowharbor.llm.quality import _let
from rowharbor.llm.tables import settled

# How works are put under a licence.
TEMPLATES = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
        "Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD-3-Clause",
        "BSD-2-Clause",
        "Released under the BSD License.",
    ),
    "CC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under CC BY-SA 4.0.",
        "CC BY 4.0",
        "CC-BY 4.0",
        "CC-BY-4.0",
        "CC-BY-SA 4.0",
        "CC-BY-SA-4.0",
        "CC-BY-NC 4.0",
        "CC0",
        "CC0 1.0 Universal",
        "Except where otherwise noted, content on this site is licensed under a Creative Commons license.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GPL-3.0-or-later",
        "GPL-2.0-only",
        "GPLv3",
        "GPLv2",
        "Released under the GNU Lesser General Public License, version 2.1.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
        "Licensed under the MIT license.",
        "Distributed under the terms of the MIT license.",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "MPL-2.0",
        "MPL 2.0",
    ),
}
# Sentences with a cue that grant nothing.
OTHER = (
    "All rights reserved.",
    "Copyright 2020, all rights reserved.",
    "The driver had no licence and was fined.",
    "A fishing license is required in this state.",
    "The agency may revoke the license at any time.",
    "Apache tribes lived in the southwest.",
    "The copyright belongs to the author of the letter.",
    "Redistribution of wealth was the topic of the debate.",
    "Licensed physicians may apply for the position.",
    "She released under pressure the terms of the agreement.",
    "The terms of the license were discussed under the old law.",
    "Under the terms of the treaty the license was void.",
    "Copyright law protects the author of a work.",
    "This work is protected by copyright.",
    "His licence was suspended for two years.",
    "Please see the license for more details.",
    "The bar lost its liquor license last week.",
    "The Apache helicopter was sold to the army.",
    "The redistribution of land in the state was slow.",
    "You may not copy this file without the permission of the owner.",
    "No part of this publication may be used without permission; copyright by the publisher.",
    "Software licensing is a large business in this state.",
    "The company was licensed to use the source of the river.",
    "The program is licensed by the city under the new act.",
    "A license is required to use this site.",
    "All content on this site is copyright of the owner and may not be used.",
    "The general public is not permitted to use the file.",
    "The license fee is due under the conditions of the contract.",
    "Licensed and insured; call us free of charge.",
    "The photo is in the public domain.",
    "The doctor is licensed in the state of Massachusetts.",
    "Commercial license only; you may not modify or use this software.",
)
#: What names a family, as a word of its text.
NAMES = {
    "Apache": r"apache.*",
    "BSD": r"bsd.*",
    "CC": r"(cc0?|cc-by.*|creative)",
    "GPL": r"[al]?gpl.*|gnu",
    "MIT": r"mit",
    "MPL": r"mpl.*|mozilla",
}
CUES = ("licen", "copyright", "spdx", "general public", "creative commons", "cc by", "permission is hereby", "redistribution", "apache", "mozilla public", "rights reserved", "public domain")
UNKNOWN = "unknown"
MAX_MISTAKEN = 0.01
CONFIRMING_SHARE = 0.6
BLANK_LINES = r"(?>\r\n|\r|\n)(?:[ \t]*(?>\r\n|\r|\n))+"
LINE_END = r"\r\n|\r|\n"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"), F.lit(0))


def _ngrams(words: Column) -> Column:
    """Distinct runs of one, two and three words."""

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.when(F.size(words) > 0, F.array_distinct(F.concat(*(runs(n) for n in (1, 2, 3))))).otherwise(
        F.array().cast("array<string>")
    )


def _cued(text: Column) -> Column:
    lowered = F.lower(text)
    found = F.lit(False)
    for cue in CUES:
        found |= F.contains(lowered, F.lit(cue))
    return found


def _literal_rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    structs = [F.struct(F.lit(a).alias("family"), F.lit(b).alias("text")) for a, b in rows]
    return spark.range(1, numPartitions=1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _pairs(words: Column) -> Column:
    """Distinct runs of two words; of a single word, itself."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, 2), " ")))


def templates(spark: SparkSession) -> DataFrame:
    """family, pairs, names: the template's pairs of words, its words that name the family."""
    rows = _literal_rows(spark, [(f, t) for f, own in TEMPLATES.items() for t in own])
    named = F.lit(None).cast("string")
    for family, pattern in NAMES.items():
        named = F.when(F.col("family") == family, F.lit(f"^(?:{pattern})$")).otherwise(named)
    words = rows.select("family", _words(F.col("text")).alias("words"), named.alias("named"))
    names = F.array_distinct(F.filter("words", lambda w: F.rlike(w, F.col("named"))))
    return words.select("family", _pairs(F.col("words")).alias("pairs"), names.alias("names"))


def _examples(docs: DataFrame, text: str, sample_paragraphs: int) -> DataFrame:
    """family, grams, kind, held_out: parts of templates, sentences that grant nothing,
    paragraphs. A half of the texts of the latter two is held out."""
    spark = docs.sparkSession
    given = _literal_rows(spark, [(f, t) for f, own in TEMPLATES.items() for t in own] + [(UNKNOWN, t) for t in OTHER])
    other = F.col("family") == UNKNOWN
    half = F.pmod(F.xxhash64("words"), F.lit(2)) == 1
    words = given.select("family", _words(F.col("text")).alias("words"), F.when(other, "cued").otherwise("template").alias("kind"))
    words = words.withColumn("held_out", other & half)
    size = F.size("words")
    # all parts that keep at least two thirds of the words, at most 25 of a text
    cut = words.select("*", F.explode(F.sequence(F.lit(0), F.least(F.floor(size / 6).cast("int"), F.lit(4)))).alias("head"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.least(F.floor(F.size("words") / 6).cast("int"), F.lit(4)))).alias("tail"))
    parts = cut.select("family", "kind", "held_out", F.slice("words", F.col("head") + 1, size - F.col("head") - F.col("tail")).alias("words"))
    share = min(1_000_000, -(-1_000_000 * sample_paragraphs // max(docs.count(), 1)))
    blocks = (
        docs.where(F.pmod(F.xxhash64(text), F.lit(1_000_000)) < share)
        # in an order of their own, so that the same texts are drawn however they are stored
        .orderBy(F.xxhash64(text), text)
        .limit(sample_paragraphs)
        .select(F.explode(F.split(text, BLANK_LINES)).alias("block"))
    )
    # as they are scored: lines, and blocks of several of them
    several = F.when(F.col("block").rlike(LINE_END), F.array("block")).otherwise(F.array().cast("array<string>"))
    lines = (
        blocks.select(F.explode(F.concat(F.split("block", LINE_END), several)).alias("line"))
        .where(~_cued(F.col("line")) & (F.char_length("line") < 10_000))
        .orderBy(F.xxhash64("line"))
        .limit(sample_paragraphs)
    )
    plain = lines.select(F.lit(UNKNOWN).alias("family"), F.lit("ordinary").alias("kind"), _words(F.col("line")).alias("words"))
    plain = plain.withColumn("held_out", half)
    return parts.unionByName(plain).select("family", "kind", "held_out", _ngrams(F.col("words")).alias("grams"))


class Classifier:
    """Weights by n-gram and family, intercepts, and the cutoff of a prediction."""

    def __init__(self, weights: dict[str, list[float]], intercepts: list[float], families: list[str], cutoff: float):
        self.weights, self.intercepts, self.families, self.cutoff = weights, intercepts, families, cutoff

    def table(self, spark: SparkSession) -> DataFrame:
        """(gram, weights): as many rows as the vocabulary has n-grams."""
        return spark.createDataFrame(sorted(self.weights.items()), "gram string, weights array<double>")


def fit(docs: DataFrame, *, text: str = "text", sample_paragraphs: int = 2000) -> Classifier:
    examples = settled(_examples(docs, text, sample_paragraphs).coalesce(1))
    families = [*sorted(TEMPLATES), UNKNOWN]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    # the vocabulary is what the templates say, whatever the corpus holds
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(
        examples.where(F.col("family") != UNKNOWN)
    )
    counted = vectors.transform(examples.withColumn("label", label.cast("double")))
    model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=40).fit(counted.where(~F.col("held_out")))
    words = vectors.vocabulary
    matrix = model.coefficientMatrix.toArray()
    weights = {w: [float(matrix[f, k]) for f in range(len(families))] for k, w in enumerate(words)}
    classifier = Classifier(weights, [float(x) for x in model.interceptVector], families, 0.0)
    held_out = examples.where("held_out").select(F.monotonically_increasing_id().alias("id"), "kind", "grams")
    worst = F.percentile("probability", F.lit(1 - MAX_MISTAKEN)).alias("worst")
    per_kind = _probabilities(held_out, classifier, ["id", "kind"]).groupBy("kind").agg(worst)
    classifier.cutoff = max(0.5, per_kind.agg(F.max("worst")).first()[0] or 0.0)
    return classifier


def _known_grams(words: Column, classifier: Classifier) -> Column:
    """Those of ``_ngrams`` that have weights."""
    singles = sorted({w for g in classifier.weights for w in g.split(" ")})
    grams = sorted(classifier.weights)

    def pairs(w: Column) -> Column:
        return F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.when(a.isin(singles) & b.isin(singles), F.concat(a, F.lit(" "), b)))

    def with_triples(w: Column, two: Column) -> Column:
        third = F.slice(w, 3, F.greatest(F.size(w), F.lit(1)))
        three = F.zip_with(two, third, lambda a, b: F.when(a.isNotNull() & b.isin(singles), F.concat(a, F.lit(" "), b)))
        return F.array_distinct(F.filter(F.concat(w, two, three), lambda g: g.isin(grams)))

    return _let(words, lambda w: _let(pairs(w), lambda two: with_triples(w, two)))


class _Bound:
    """What no paragraph of known n-grams can exceed: for the family that gains most by
    each n-gram, its weight over that of the unknown class, rounded up to a few steps."""

    def __init__(self, classifier: Classifier, steps: int = 6):
        at = classifier.families.index(UNKNOWN)
        own = [k for k in range(len(classifier.families)) if k != at]
        gains = {g: max(w[k] - w[at] for k in own) for g, w in classifier.weights.items()}
        self.needed = min(classifier.intercepts[at] - classifier.intercepts[k] for k in own) - 1e-6
        top = max(gains.values(), default=0.0)
        self.steps = []
        for n in range(steps):
            high, low = top / 2**n, top / 2 ** (n + 1) if n < steps - 1 else 0.0
            held = sorted(g for g, x in gains.items() if low < x <= high)
            if held:
                self.steps.append((high, held))

    def reaches(self, grams: Column) -> Column:
        total = F.lit(0.0)
        for high, held in self.steps:
            total = total + F.size(F.filter(grams, lambda g: g.isin(held))) * F.lit(high)
        return total >= F.lit(self.needed)


def _probabilities(rows: DataFrame, classifier: Classifier, keys: list[str]) -> DataFrame:
    """``keys``, the likeliest licence family and its probability."""
    spark = rows.sparkSession
    n = len(classifier.families)
    sums = [F.coalesce(F.sum(F.col("weights")[k]), F.lit(0.0)).alias(f"w{k}") for k in range(n)]
    scored = (
        rows.select(*keys, F.explode_outer("grams").alias("gram"))
        .join(F.broadcast(classifier.table(spark)), "gram", "left")  # the templates' n-grams
        .groupBy(*keys)
        .agg(*sums)
    )
    logits = [F.col(f"w{k}") + F.lit(b) for k, b in enumerate(classifier.intercepts)]
    top = F.greatest(*logits)
    total = sum((F.exp(x - top) for x in logits[1:]), F.exp(logits[0] - top))
    options = F.array(
        *[
            F.struct((-F.exp(x - top) / total).alias("p"), F.lit(f).alias("family"))
            for x, f in zip(logits, classifier.families)
            if f != UNKNOWN
        ]
    )
    best = F.array_min(options)
    return scored.select(*keys, best["family"].alias("family"), (-best["p"]).alias("probability"))


def _paragraphs(docs: DataFrame, classifier: Classifier, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_hash, block, line, joined, cued, grams of all lines and all blocks of
    several lines that have a cue or may be of a family."""
    bound = _Bound(classifier)
    blocks = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, BLANK_LINES)).alias("block", "body")
    )
    no_words = F.array().cast("array<string>")

    def unit(line: Column, joined: Column, cued: Column, words: Column) -> Column:
        return F.struct(line.alias("line"), joined.alias("joined"), cued.alias("cued"), words.alias("words"))

    def with_block(units: Column) -> Column:
        all_words = F.flatten(F.transform(units, lambda u: u["words"]))
        whole = F.array(unit(F.size(units), F.lit(True), F.lit(False), all_words))
        return F.concat(units, F.when(F.size(units) > 1, whole).otherwise(F.slice(whole, 1, 0)))

    lines = F.transform(
        F.split("body", LINE_END), lambda l, k: unit(k, F.lit(False), F.coalesce(_cued(l), F.lit(False)), F.coalesce(_words(l), no_words))
    )
    with_grams = F.transform(
        _let(lines, with_block),
        lambda u: F.struct(u["line"].alias("line"), u["joined"].alias("joined"), u["cued"].alias("cued"), _known_grams(u["words"], classifier).alias("grams")),
    )
    scored = F.filter(with_grams, lambda u: u["cued"] | bound.reaches(u["grams"]))
    # not before they are scored: what is exploded is little
    return (
        blocks.select("doc_id", "text_hash", "block", F.explode(scored).alias("u"))
        .select("doc_id", "text_hash", "block", "u.*")
        .dropDuplicates(["doc_id", "text_hash", "block", "line"])
    )


def statements(docs: DataFrame, classifier: Classifier, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, block, line, family, probability, confirmed of every statement;
    the family is ``unknown`` below the cutoff, the line is null for a whole block."""
    spark = docs.sparkSession
    keys = ["doc_id", "text_hash", "block", "line", "joined", "cued", "grams"]
    found = _probabilities(_paragraphs(docs, classifier, doc_id, text), classifier, keys)
    own = templates(spark).groupBy("family").agg(F.collect_list(F.struct("pairs", "names")).alias("templates"))

    def held(t: Column) -> Column:
        named = (F.size(t["names"]) == 0) | F.arrays_overlap(t["names"], F.col("grams"))
        return F.when(named, F.size(F.array_intersect(t["pairs"], F.col("grams"))) / F.size(t["pairs"])).otherwise(F.lit(0.0))

    share = F.array_max(F.transform("templates", held))
    known = F.col("probability") >= classifier.cutoff
    judged = found.where(known | F.col("cued")).join(F.broadcast(own), "family", "left").select(  # one row a family
        "doc_id",
        "text_hash",
        "block",
        "line",
        "joined",
        known.alias("known"),
        F.when(known, F.col("family")).otherwise(F.lit(UNKNOWN)).alias("family"),
        "probability",
        (F.coalesce(share, F.lit(0.0)) >= CONFIRMING_SHARE).alias("confirmed"),
    )
    block = Window.partitionBy("doc_id", "text_hash", "block")  # statements of one block of one text
    by_line = F.max(F.col("known") & F.col("confirmed") & ~F.col("joined")).over(block)
    line_families = F.collect_set(F.when(F.col("known") & ~F.col("joined"), F.col("family"))).over(block)
    block_family = F.max(F.when(F.col("known") & F.col("joined"), F.col("family"))).over(block)
    same = F.size(F.array_except("line_families", F.array("block_family"))) == 0
    return (
        judged.withColumns({"by_line": by_line, "line_families": line_families, "block_family": block_family})
        .where(F.col("joined") == (~F.col("by_line") & F.col("block_family").isNotNull() & same))
        .select("doc_id", "text_hash", "block", F.when(~F.col("joined"), F.col("line")).alias("line"), "family", "probability", "confirmed")
    )


def scanned(docs: DataFrame, classifier: Classifier, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, family, score, confirmed, n_statements, families of every document."""
    likeliest = F.min(F.struct(F.when(F.col("family") == UNKNOWN, 1).otherwise(0), -F.col("probability"), "family", "probability", "confirmed"))
    per_doc = (
        statements(docs, classifier, doc_id=doc_id, text=text)
        .groupBy(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"))
        .agg(likeliest.alias("best"), F.count("*").alias("n"), F.array_sort(F.collect_set("family")).alias("families"))
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    same = rows["doc_id"].eqNullSafe(F.col("of_doc")) & (rows["text_hash"] == F.col("of_text"))
    return rows.join(per_doc, same, "left").select(
        "doc_id",
        F.col("best.family").alias("family"),
        F.coalesce("best.probability", F.lit(0.0)).alias("score"),
        (F.coalesce("best.confirmed", F.lit(False)) & (F.coalesce("best.family", F.lit(UNKNOWN)) != UNKNOWN)).alias("confirmed"),
        F.coalesce("n", F.lit(0)).alias("n_statements"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
    )
