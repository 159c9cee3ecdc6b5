"""The mixture against a plain program: budgets by filling children one after another,
documents by sorting each leaf."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest

from rowharbor.llm import mixing
from rowharbor.llm.queries import MIX, op2_mix

SF_DIR = "/root/testdata/sf0.001"
NO_NAME = "(null)"


def poured(children, given):
    """Budget by name; children are (name, weight, capacity)."""
    left = sorted((c for c in children if c[1] > 0), key=lambda c: (Fraction(c[2], c[1]), c[0]))
    budget = dict.fromkeys((c[0] for c in children), 0)
    while left:
        weights = sum(c[1] for c in left)
        full = [c for c in left if c[2] * weights <= given * c[1]]
        if not full:
            break
        for name, _, capacity in full:
            budget[name] = capacity
            given -= capacity
        left = [c for c in left if c not in full]
    weights, reached = sum(c[1] for c in left), 0
    for name, weight, capacity in left:
        share = given * (reached + weight) // weights - given * reached // weights
        budget[name] = min(share, capacity)
        reached += weight
    return budget


def weight(level, name):
    own = MIX.get(level, {})
    return own.get(name, own.get("*", 1))


def plain_mixture(docs, share=0.5, epochs=3, seed=17):
    leaves = defaultdict(list)
    for doc_id, text, lang, source in docs:
        domain = NO_NAME if source is None else f"d{zlib.crc32(source.encode()) % 4}"
        tokens = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        key = f"{seed}|{NO_NAME if doc_id is None else doc_id}|{zlib.crc32((text or '').encode())}"
        order = hashlib.md5(key.encode()).hexdigest()
        leaf = (domain, NO_NAME if lang is None else lang, NO_NAME if source is None else source)
        leaves[leaf].append((doc_id, tokens, order))
    sizes = {leaf: sum(t for _, t, _ in own) for leaf, own in leaves.items()}
    given = {(): int(sum(sizes.values()) * share)}
    for depth, level in enumerate(mixing.LEVELS):
        below = defaultdict(lambda: defaultdict(int))
        for leaf, n in sizes.items():
            below[leaf[:depth]][leaf[depth]] += n * epochs
        given = {
            (*parent, name): budget
            for parent, children in below.items()
            for name, budget in poured([(n, weight(level, n), c) for n, c in children.items()], given[parent]).items()
        }
    out = []
    for leaf, own in leaves.items():
        whole, rest = divmod(given[leaf], sizes[leaf]) if sizes[leaf] else (0, 0)
        again = [(hashlib.md5(f"{o}|{whole}".encode()).hexdigest(), i, t) for i, t, o in own]
        before = 0
        for _, doc_id, tokens in sorted(again):
            out.append((doc_id, *leaf, tokens, given[leaf], whole + (tokens > 0 and before < rest)))
            before += tokens
    return sorted(out)


@pytest.mark.parametrize("ranges", [4_096, 3])
def test_mixture_of_whole_documents(spark, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "RANGE_ROWS", ranges)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source")
    columns = ["doc_id", *mixing.LEVELS, "tokens", "leaf_budget", "copies"]
    got = sorted(tuple(r) for r in op2_mix(spark, SF_DIR).select(*columns).collect())
    assert got == plain_mixture([tuple(r) for r in docs.collect()])


def test_budgets_of_drawn_children(spark):
    draw = random.Random(9)
    rows = [
        (f"p{p}", f"c{c:02}", draw.choice([0, 1, 1, 2, 5]), draw.choice([0, 3, 50, 1000, draw.randint(1, 400)]))
        for p in range(30)
        for c in range(draw.randint(1, 9))
    ]
    given = {f"p{p}": draw.choice([0, 1, 77, draw.randint(0, 3000)]) for p in range(30)}
    children = spark.createDataFrame(rows, "parent string, name string, weight long, capacity long")
    budgets = spark.createDataFrame(list(given.items()), "parent string, budget long")
    got = {(r.parent, r.name): r.budget for r in mixing.poured(children, ["parent"], budgets, 0).collect()}
    want = {
        (p, name): b
        for p, g in given.items()
        for name, b in poured([r[1:] for r in rows if r[0] == p], g).items()
    }
    assert got == want
