"""The licence scan covers all paragraphs, with or without a cue, wrapped or not."""

import pytest
from pyspark.sql import functions as F

from rowharbor.llm import licences

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, f"the man of the town went on with it and the dog {i}\nto the park in the year {i}") for i in range(200)]
    return licences.fit(spark.createDataFrame(rows, DOCS))


def scan(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    return sorted(licences.scanned(docs, model).collect(), key=lambda r: r.doc_id)


def test_paragraphs_without_a_cue_are_scored(spark, model):
    cases = {
        "prose\nGPL-3.0-or-later": "GPL", "GPLv3": "GPL", "MPL 2.0": "MPL", "BSD-3-Clause": "BSD", "CC-BY-SA 4.0": "CC", "CC0": "CC",
        "Distributed under the terms of the MIT": "MIT", "placed in the public domain": "unknown", "All rights reserved.": "unknown",
        "the man went to the park": None, "": None,
    }
    got = scan(spark, model, list(cases))
    assert [r.family for r in got] == list(cases.values())
    assert [r.n_statements for r in got] == [int(f is not None) for f in cases.values()]


def test_wrapped_notices_are_one_statement(spark, model):
    notice = "This program is free software: you can redistribute\r\nit and/or modify it under the terms of the\r\nGNU General Public License."
    two = "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."
    got = scan(spark, model, [f"prose\r\n\r\n{notice}\r\n \r\nmore", "Licensed under the Apache\nLicense, Version 2.0", two])
    assert [(r.family, r.n_statements, r.families) for r in got[:2]] == [("GPL", 1, ["GPL"]), ("Apache", 1, ["Apache"])]
    assert (got[2].n_statements, got[2].families) == (2, ["Apache", "MIT"])


def test_no_paragraph_over_the_cutoff_is_left_out_early(spark, model):
    bound = licences._Bound(model)
    words = " ".join(t for own in licences.TEMPLATES.values() for t in own).split()
    texts = [" ".join(words[k : k + n]) for n in (1, 2, 3, 5, 9) for k in range(len(words))]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").withColumn("words", licences._words(F.col("text")))
    rows = rows.select("id", licences._known_grams(F.col("words"), model).alias("grams"), F.array_intersect(licences._ngrams(F.col("words")), F.array(*map(F.lit, model.weights))).alias("want"))
    assert rows.where(F.array_sort("grams") != F.array_sort("want")).count() == 0
    found = licences._probabilities(rows, model, ["id", "grams"])
    assert found.where((F.col("probability") >= model.cutoff) & ~bound.reaches(F.col("grams"))).count() == 0
    assert found.where(~bound.reaches(F.col("grams"))).count() > 0


def test_confirmation_needs_the_order_and_the_name(spark):
    own = {r.family: [] for r in licences.templates(spark).collect()}
    for r in licences.templates(spark).collect():
        own[r.family].append(r)
    pairs = [set(r.pairs) for r in own["MIT"]]
    assert {"released under", "under the", "the mit", "mit license"} in pairs
    assert all(r.names for r in own["Apache"]) and any(r.names == ["mit"] for r in own["MIT"])
    sure = licences.Classifier({g: [0.0, 0.0, 0.0, 0.0, 50.0, 0.0, 0.0] for g in ("mit", "license", "under", "the", "released", "under the")}, [0.0] * 7, [*sorted(licences.TEMPLATES), licences.UNKNOWN], 0.5)
    sure.weights |= {g: [0.0] * 7 for g in ("released under", "the mit", "mit license")}
    got = scan(spark, sure, ["Under license, the released fish", "the license under MIT released", "Released under the MIT License."])
    assert [(r.family, r.confirmed) for r in got] == [("MIT", False), ("MIT", False), ("MIT", True)]


def test_the_cutoff_is_set_on_examples_that_are_not_fitted(spark, model):
    docs = spark.createDataFrame([(i, f"the man of the town {i}") for i in range(200)], DOCS)
    examples = licences._examples(docs, "text", 2000)
    assert {(r.kind, r.held_out) for r in examples.select("kind", "held_out").distinct().collect()} == {
        ("template", False), ("cued", True), ("cued", False), ("ordinary", True), ("ordinary", False)
    }
    held = examples.where("held_out and kind = 'cued'").select(F.monotonically_increasing_id().alias("id"), "grams")
    found = licences._probabilities(held, model, ["id"])
    n = found.count()
    assert n > 20 and found.where(F.col("probability") > model.cutoff).count() <= 1 + licences.MAX_MISTAKEN * n
