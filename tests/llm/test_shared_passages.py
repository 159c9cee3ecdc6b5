"""A passage that many benchmark items share, and items that repeat."""

import random

import pytest

from rowharbor.llm import contamination


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


@pytest.mark.parametrize("at_once", [10, 1 << 20])
def test_a_passage_that_many_items_share(spark, monkeypatch, at_once):
    monkeypatch.setattr(contamination, "MATCHES_AT_ONCE", at_once)
    rng = random.Random(7)
    passage = words(rng, 12)
    items = [(i, f"{passage} {words(rng, 6)}") for i in range(40)] * 3
    texts = [f"{words(rng, 5)} {passage} {words(rng, 5)}" if i % 2 else words(rng, 30) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contaminated(contamination.contamination(docs, benchmark)).collect()
    for r in found:
        assert r.n_hit == (12 if r.doc_id % 2 else 0)
        assert r.n_items == (40 if r.doc_id % 2 else 0)
        places = {(m.item_id, m.item_word, m.doc_word, m.n_words) for m in r.matches or ()}
        assert places == ({(str(i), 0, 5, 12) for i in range(40)} if r.doc_id % 2 else set())
    clean = contamination.uncontaminated(docs, benchmark)
    assert sorted(r.doc_id for r in clean.collect()) == list(range(0, 30, 2))
