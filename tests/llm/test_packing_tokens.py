"""Token ids and packing against the plain library and the laws of a packing."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from rowharbor.llm import packing, tokens
from rowharbor.llm.combinations import combinations, nnls, packing_plan

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "ab Z9 '\n\t  .,!é ßñ中あ한😀  \u0085\x1c٣²'sn'tI'll  "


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("piece", [5, 1 << 20])
def test_ids_are_those_of_the_library(plain, monkeypatch, piece):
    monkeypatch.setattr(tokens, "SLICE", piece)
    ids, draw = tokens.Ids(PATH), random.Random(3)
    for n in range(600):
        text = "".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 60)))
        text += "<|endoftext|> end" * (n % 100 == 0)
        assert np.frombuffer(ids.of(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def placed_by(plan):
    fill = np.zeros(plan.sequences, dtype=int)
    for _, _, count, sequence, _, head, _, _ in plan.entries:
        fill[sequence : sequence + count] += head
    return fill


@pytest.mark.parametrize(
    "lengths",
    [
        [],
        [5],
        [2048] * 3,
        [1] * 50_000,
        [700] * 1000,
        list(np.random.default_rng(1).integers(1, 2049, 30_000)),
        list(np.random.default_rng(2).integers(100, 300, 30_000)),
        [1] * 20_000 + list(np.random.default_rng(3).integers(1, 2049, 1000)),
    ],
)
def test_plan_places_all_tokens_with_little_padding(lengths):
    plan = packing_plan(Counter(int(n) for n in lengths), 2048)
    fill = placed_by(plan)
    assert fill.sum() == sum(lengths)
    assert (fill > 0).all() and (fill <= 2048).all()
    # but for one sequence, less than two in a hundred tokens are padding
    assert plan.sequences <= 1 + sum(lengths) / 2048 / 0.98


@pytest.mark.parametrize("window", [1, 2, 7, 1000])
def test_plan_of_other_windows(window):
    lengths = np.random.default_rng(window).integers(1, window + 1, 500)
    fill = placed_by(packing_plan(Counter(lengths.tolist()), window))
    assert fill.sum() == lengths.sum() and (fill <= window).all()


def test_counts_are_the_least_squares_ones():
    draw = np.random.default_rng(4)
    matrix, listed = combinations(16)
    assert all(sum(m * n for m, n in members) == 16 for members in listed)
    for _ in range(20):
        exact = np.where(draw.random(matrix.shape[1]) < 0.2, draw.integers(0, 50, matrix.shape[1]), 0)
        x = nnls(matrix, matrix @ exact)
        assert (x >= 0).all() and np.abs(matrix @ x - matrix @ exact).max() < 1e-3
    wanted = draw.integers(0, 100, 16).astype(float)
    x = nnls(matrix, wanted)
    slope = matrix.T @ (wanted - matrix @ x)
    # no count can be raised, and none above 0 lowered, to come nearer
    assert slope.max() < 1e-3 and np.abs(slope[x > 0]).max() < 1e-3


def laws(rows, docs, plain, window):
    """All laws of a packing; gives the tokens of each sequence."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            part = struct.pack(f"<{r.length}I", *ids[at : at + r.length])
            assert (r.start, r.doc_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(part), part)
            at += r.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    fill = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        fill.append(at)
    return fill


def test_packing_of_whole_documents(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = packing.packed(docs, PATH)
    fill = laws(found.collect(), [(r.doc_id, r.text) for r in docs.collect()], plain, 2048)
    assert sum(fill) / len(fill) > 0.98 * 2048
    whole = packing.sequences(found).collect()
    assert sorted(r.tokens for r in whole) == sorted(fill)
    assert all(len(r.ids) == 4 * r.tokens for r in whole)


def test_packing_of_awkward_rows(spark, plain):
    texts = [None, "", "a", " ", "\n\n", "word " * 700, "x" * 9000, "same text"] + ["same text"] * 40
    rows = [(i, t, 7, "t") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, ids string").repartition(3)
    fill = laws(packing.packed(docs, PATH, window=64).collect(), [r[:2] for r in rows], plain, 64)
    assert sum(fill) >= 64 * (len(fill) - 1) * 0.9
    odd = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    assert packing.packed(odd, PATH).groupBy("doc_id").sum("length").orderBy("doc_id").collect() == [(None, 4), (1, 4)]
    assert packing.packed(docs.limit(0), PATH).collect() == []


def test_counts_too_many_to_broadcast_are_joined(spark, plain, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    rows = [(i, "some words " * (i % 9)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    laws(packing.packed(docs, PATH, window=32).collect(), rows, plain, 32)
