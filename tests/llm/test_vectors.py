"""Vector codes and hard negatives against plain programs that compare everything."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowharbor.llm import codes, hilbert, negatives

ROWS = "vec_id long, embedding array<float>, label int, ints string, block int, code int"


def kept(rows):
    return [
        (i, label, [int(np.floor(256 * float(np.float32(c)))) for c in v])
        for i, v, label in rows
        if v is not None and all(c is not None and np.isfinite(c) for c in v)
    ]


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], ROWS).repartition(parts)


def plain_codes(rows, parts=16, entries=64, rounds=2):
    own = kept(rows)
    width = max(len(v) for *_, v in own)
    per = max(1, -(-width // parts))
    x = np.array([v + [0] * (per * parts - len(v)) for *_, v in own], dtype=np.int64).reshape(len(own), parts, per)
    first = {}
    for n, (i, _, v) in enumerate(own):
        key = (i is None, i or 0)
        if key not in first or v < own[first[key]][2]:
            first[key] = n
    start = [first[k] for k in sorted(first)[:entries]]
    books = x[start].transpose(1, 0, 2).copy()

    def held(p):
        return ((x[:, p][:, None] - books[p][None]) ** 2).sum(axis=2).argmin(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            at = held(p)
            for e in set(at):
                books[p][e] = x[at == e, p].sum(axis=0) // (at == e).sum()
    code = np.stack([held(p) for p in range(parts)], axis=1)
    error = sum(((x[:, p] - books[p][code[:, p]]) ** 2).sum(axis=1) for p in range(parts))
    digest = hashlib.sha256(",".join(str(c) for c in books.ravel()).encode()).hexdigest()
    by_label = {}
    for (_, label, _), e in zip(own, error, strict=True):
        by_label[label] = by_label.get(label, 0) + int(e)
    return sorted(
        (str(i), code[n].astype(np.uint8).tobytes().hex(), int(error[n]), by_label[label], digest)
        for n, (i, label, _) in enumerate(own)
    )


def spark_codes(df, **options):
    found = codes.compressed(df, **options).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((str(r[0]), *r[1:]) for r in found.collect())


def plain_negatives(rows, every=50):
    own = [r for r in kept(rows) if r[1] is not None]
    if not own:
        return []
    width = max(len(v) for *_, v in own)
    x = np.array([v + [0] * (width - len(v)) for *_, v in own], dtype=np.int64).reshape(len(own), width)
    ids = np.array([negatives.NO_ID if i is None else i for i, *_ in own])
    labels = np.array([label for _, label, _ in own])
    out = []
    for a in [n for n, r in enumerate(own) if r[0] is not None and r[0] % every == 0]:
        s = x @ x[a]
        order = np.lexsort((ids, -s))
        for p in [j for j in order if labels[j] == labels[a] and j != a][:5]:
            found = [j for j in order if labels[j] != labels[a] and 50 * s[p] <= 100 * s[j] <= 95 * s[p]][:3]
            out += [(own[a][0], own[p][0], n + 1, own[j][0], s[p], s[j]) for n, j in enumerate(found)]
    return sorted(tuple(map(str, r)) for r in out)


def spark_negatives(df, every=50):
    found = negatives.mined(df, F.col("vec_id") % every == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
    return sorted(tuple(map(str, r)) for r in found.collect())


def drawn(n, width=16, seed=0, spots=5):
    """Rows around a few spots, so that zone maps have something to leave out."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 0.4, (spots, width))
    spot = draw.integers(0, spots, n)
    x = (centres[spot] + draw.normal(0, 0.1, (n, width))).astype(np.float32)
    return [(i, x[i].tolist(), int(draw.integers(0, 4))) for i in range(n)]


AWKWARD = [
    (0, [0.5, -0.25, 1.0], 1),
    (0, [0.5, -0.25, 1.0], 1),
    (0, [0.25, 0.25], 2),
    (50, [], 1),
    (100, None, 1),
    (150, [0.5, None, 1.0], 1),
    (200, [float("nan"), 0.0, 1.0], 1),
    (250, [float("inf"), 0.0, 1.0], 2),
    (300, [0.4, -0.2, 0.9], None),
    (None, [0.3, -0.2, 0.7], 2),
    (-50, [0.45, -0.2, 0.8, 0.1], 2),
    *[(7, [0.3, -0.2, 0.7], 3)] * 30,
    *[(350, [0.5, -0.25, 0.9], 1)] * 3,
]


@pytest.mark.parametrize("dimensions,bits", [(1, 5), (2, 4), (3, 3), (5, 2)])
def test_curve_goes_to_a_neighbour_in_every_step(dimensions, bits):
    axes = [np.arange(1 << bits)] * dimensions
    grid = np.stack(np.meshgrid(*axes, indexing="ij"), axis=-1).reshape(-1, dimensions)
    keys = hilbert.curve_keys(grid, bits)
    order = sorted(range(len(keys)), key=keys.__getitem__)
    assert len(set(keys)) == len(keys)
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_balls_give_the_nearest_entry():
    draw = np.random.default_rng(5)
    for _ in range(300):
        x = draw.integers(-6, 7, (draw.integers(0, 60), 3))
        book = draw.integers(-6, 7, (draw.integers(1, 20), 3))
        held = draw.integers(0, len(book), len(x))
        assert (codes.nearest(x, book) == codes.nearest_by_balls(x, book, held)).all()


def test_codes_of_awkward_rows(spark):
    assert spark_codes(table(spark, AWKWARD), parts=2, entries=4) == plain_codes(AWKWARD, parts=2, entries=4)
    assert spark_codes(table(spark, AWKWARD)) == plain_codes(AWKWARD)
    assert spark_codes(table(spark, AWKWARD).limit(0)) == []


def test_codes_with_labels_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(codes, "BROADCAST_ROWS", 0)
    rows = drawn(300) + [(i, [0.1] * 16, None) for i in range(300, 320)]
    assert spark_codes(table(spark, rows)) == plain_codes(rows)


def test_bounds_hold_every_row_of_a_block():
    draw = np.random.default_rng(6)
    a, x = draw.integers(-9, 10, (20, 6)), draw.integers(-9, 10, (40, 6))
    least, most = negatives.interval(a, x.min(0)[None], x.max(0)[None])
    s = negatives.scores(a, x)
    assert (s == a @ x.T).all() and (least <= s).all() and (s <= most).all()
    large = np.array([[negatives.EXACT // 3, 1]])
    assert negatives.scores(large, np.array([[3, 1]])).tolist() == [[negatives.EXACT // 3 * 3 + 1]]


@pytest.mark.parametrize("block,group,page", [(2048, 1024, 4096), (16, 3, 4)])
def test_negatives_with_few_and_many_blocks(spark, monkeypatch, block, group, page):
    for name, value in (("BLOCK", block), ("GROUP", group), ("PAGE", page), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(negatives, name, value)
    rows = drawn(600, seed=7)
    # a third of all rows are copies of one
    rows += [(600 + i, rows[0][1], i % 2) for i in range(300)]
    assert spark_negatives(table(spark, rows), every=10) == plain_negatives(rows, every=10)


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 32)
    read = []
    needed = negatives._needed
    monkeypatch.setattr(negatives, "_needed", lambda *a: read.append(needed(*a)) or read[-1])
    rows = drawn(2000, width=3, seed=8, spots=40)
    assert spark_negatives(table(spark, rows), every=1000) == plain_negatives(rows, every=1000)
    blocks = -(-len(rows) // 32)
    assert all(pairs.count() < 0.7 * blocks for pairs in read)


def test_negatives_of_awkward_rows(spark):
    assert spark_negatives(table(spark, AWKWARD)) == plain_negatives(AWKWARD)
    assert spark_negatives(table(spark, AWKWARD).limit(0)) == []
    named = table(spark, drawn(200)).withColumn("label", F.concat(F.lit("l"), "label"))
    assert spark_negatives(named) == plain_negatives(drawn(200))
