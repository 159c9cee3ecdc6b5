"""Shards are cut along the dimension that is widest in its own range."""

import random

import pytest
from pyspark.sql import functions as F

from rowharbor.llm import sharding

DOCS = "doc_id long, text string, lang string, source string"


def found(spark, rows, n):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sharding.shards(docs, n)
    return {r.doc_id: r for r in got.collect()}


def word(rng, n):
    return "".join(rng.choice("abcdefgh ") for _ in range(n))


def test_sizes_of_two_kinds_are_split_by_size(spark):
    rng = random.Random(1)
    rows = [(i, word(rng, 40), "en", "one") for i in range(2000)]
    rows += [(2000 + i, word(rng, 4000), "en", "one") for i in range(24)]
    got = found(spark, rows, 2)
    small, large = ({got[i].shard for i in r} for r in (range(2000), range(2000, 2024)))
    assert small == {0} and large == {1}


@pytest.mark.parametrize("limit", [0, 200_000])
def test_names_are_split_in_their_order(spark, monkeypatch, limit):
    monkeypatch.setattr(sharding, "BROADCAST_NAMES", limit)
    rng = random.Random(2)
    rows = [(i, word(rng, 60), "en", "abcdefgh"[i % 8]) for i in range(1600)]
    got = found(spark, rows, 4)
    for i, r in got.items():
        assert r.shard == (i % 8) // 2


def test_a_hot_source_is_cut_along_something_else(spark):
    rng = random.Random(3)
    rows = [(i, word(rng, rng.randint(20, 400)), "en", "hot" if i % 3 else f"s{i % 50}") for i in range(3000)]
    got = found(spark, rows, 8)
    sizes = [sum(r.size for r in got.values() if r.shard == s) for s in range(8)]
    assert max(sizes) < 1.05 * sum(sizes) / 8 and min(sizes) > 0.95 * sum(sizes) / 8
    in_hot = {r.shard for i, r in got.items() if i % 3}
    assert len(in_hot) >= 5
