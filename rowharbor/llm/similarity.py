"""Near-duplicate join: word 5-grams, Jaccard similarity of 0.8 or more.

Texts with the same set of shingles are taken together first. Of each set a MinHash
sketch is kept, and sets that agree in a band of the sketch become candidates. Pairs
of candidates are then judged by their sketches, some values at a time: with m of n
values equal and a uniform prior, the chance that the similarity reaches the
threshold is P(Binomial(n + 1, threshold) <= m), and a pair for which it falls below
``TOLERANCE`` is dropped at once. What is left is verified on the sets themselves.

Pairs never become rows. Buckets and components are compared inside tasks; one of
more than ``BLOCK`` sets is divided into chunks, and each pair of chunks is a task's
work of its own, so that no group has a size limit. What leaves a task are counts of
links per set and a spanning forest of the links.

Of two sets that are exactly 0.8 alike, 3 in a million pairs share no band; the
tolerance loses 1 in a million at each of five steps. Sets are named by 64 bits.

Defined results: words are runs of digits, a-z (A-Z lower-cased) and characters
beyond ASCII; a text of one to four words is one shingle; a text without words is
one shingle, itself; null and empty texts and rows without an id are alone (class:
their id, no links); repeated rows are copies of each other; an empty table gives an
empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.llm.components import components
from rowharbor.llm.scan import (
    ascii_words,
    mix,
    ranges,
    span_hashes,
    text_column,
    text_slices,
    whole_groups,
)
from rowharbor.llm.tables import settled

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP = 32
TOLERANCE = 1e-6
BLOCK = 1024
BROADCAST_ROWS = 200_000
PAIRS_AT_ONCE = 1 << 19
COLUMNS_AT_ONCE = 2048

_SEEDS = np.random.default_rng(20).integers(1, 1 << 32, (2, HASHES), np.uint64).astype(np.uint32) | np.uint32(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice, and their offsets."""
    words, first = ascii_words(data, offsets)
    n_words = np.diff(first)
    count = np.where(n_words > 0, np.maximum(n_words - SHINGLE_WORDS + 1, 1), 0)
    at = ranges(first[:-1], count)
    owner = np.repeat(np.arange(len(count)), count)
    size = np.minimum(n_words, SHINGLE_WORDS)[owner]
    padded = np.concatenate([words, np.zeros(SHINGLE_WORDS, np.uint64)])
    hashed = size.astype(np.uint64)
    for k in range(SHINGLE_WORDS):
        hashed = hashed * np.uint64(0x5851F42D4C957F2D) + np.where(k < size, padded[at + k], np.uint64(k))
    hashed = mix(hashed)
    bare = np.flatnonzero((n_words == 0) & (np.diff(offsets) > 0))
    if len(bare):
        whole = span_hashes(data.astype(np.uint64), offsets[bare], offsets[bare + 1])
        hashed, owner = np.concatenate([hashed, whole]), np.concatenate([owner, bare])
    order = np.argsort(hashed)
    narrow = owner.astype(np.uint16) if len(count) < 1 << 16 else owner
    order = order[np.argsort(narrow[order], kind="stable")]
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    hashed, owner = hashed[new], owner[new]
    return hashed, np.searchsorted(owner, np.arange(len(count) + 1))


def set_names(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for an empty one."""
    names = np.zeros(len(offsets) - 1, np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        sums = np.add.reduceat(mix(hashes + np.uint64(7)), offsets[full])
        twice = np.bitwise_xor.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), offsets[full])
        names[full] = mix(sums + mix(twice)) | np.uint64(1)
    return names.view(np.int64)


def sketches(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values (16 bits of each) of the sets that are not empty."""
    full = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(full), HASHES), np.uint16)
    if len(full):
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        for k in range(HASHES):
            v = short * _SEEDS[0, k]
            v ^= v >> np.uint32(15)
            v *= _SEEDS[1, k]
            least = np.minimum.reduceat(v, full)
            out[:, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For n compared values, the fewest matches with which a pair goes on."""
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 2):
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out[n] = m
                break
    return out


def _surviving(sketch: np.ndarray, left: np.ndarray, right: np.ndarray, least: dict[int, int]):
    """The pairs whose chance to be alike stays above the tolerance."""
    matches = np.zeros(len(left), np.int64)
    for n, fewest in least.items():
        part = slice(n - STEP, n)
        matches += (sketch[left, part] == sketch[right, part]).sum(axis=1)
        on = matches >= fewest
        left, right, matches = left[on], right[on], matches[on]
    return left, right


def _pairs(group: np.ndarray, side: np.ndarray, cross: np.ndarray):
    """All pairs of rows of equal (sorted) group, some at a time; in a cross block
    only those of different sides."""
    n = len(group)
    last = np.searchsorted(group, group, side="right")
    partners = last - np.arange(n) - 1
    done = np.cumsum(partners)
    at = 0
    while at < n:
        base = done[at - 1] if at else 0
        to = max(int(np.searchsorted(done, base + PAIRS_AT_ONCE, side="right")), at + 1)
        left = np.repeat(np.arange(at, to), partners[at:to])
        right = ranges(np.arange(at, to) + 1, partners[at:to])
        keep = ~cross[left] | (side[left] != side[right])
        yield left[keep], right[keep]
        at = to


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least row of each row's component."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        open_ = a != b
        if not open_.any():
            break
        left, right = left[open_], right[open_]
        low, high = np.minimum(a, b)[open_], np.maximum(a, b)[open_]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    return root


def _ids(*columns: np.ndarray) -> np.ndarray:
    """Numbers of the groups of sorted rows."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in text_slices(text_column(batch, "text")):
            hashes, first = shingle_sets(data, offsets)
            size = np.diff(first)
            blobs = iter(sketches(hashes, first))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(batch.schema.get_field_index("doc_id"))[row:end],
                    "set_id": pa.array(set_names(hashes, first), mask=size == 0),
                    "sketch": pa.array([next(blobs).tobytes() if s else None for s in size], pa.binary()),
                }
            )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(-1, HASHES)


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sketch = _matrix(batch.column(batch.schema.get_field_index("sketch"))).astype(np.uint64)
        own = batch.column(batch.schema.get_field_index("set_id")).to_numpy()
        keys = np.empty((len(own), BANDS), np.uint64)
        for b in range(BANDS):
            key = np.full(len(own), b, np.uint64)
            for k in range(b * ROWS, (b + 1) * ROWS):
                key = key * np.uint64(0x5851F42D4C957F2D) + sketch[:, k] + np.uint64(1)
            keys[:, b] = mix(key)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(own, BANDS))], ["key", "set_id"]
        )


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _candidate_batches(least: dict[int, int]):
    """A spanning forest of the pairs that survive, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key", "block"]):
            key, block, side, cross, own = _columns(table, "key", "block", "side", "cross", "set_id")
            sketch = _matrix(table.column("sketch"))
            found = [
                _surviving(sketch, a, b, least) for a, b in _pairs(_ids(key, block), side, cross)
            ]
            if not found:
                continue
            root = _roots(len(own), *(np.concatenate(x) for x in zip(*found)))
            hung = root != np.arange(len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[hung]), pa.array(own[root[hung]])], ["u", "v"]
            )

    return run


def _intersections(hashes: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Common shingles of all pairs of ``rows``; only shared ones need a column."""
    size = np.diff(first)[rows]
    values = hashes[ranges(first[rows], size)]
    owner = np.repeat(np.arange(len(rows)), size)
    _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(rows), len(rows)), np.float32)
    for begin in range(0, int(shared.sum()), COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS_AT_ONCE])
        held = np.zeros((len(rows), COLUMNS_AT_ONCE), np.float32)
        held[owner[a:b], column[a:b] - begin] = 1
        total += held @ held.T
    return total


def _verified(hashes, first, left, right, threshold: float) -> np.ndarray:
    """Which of the pairs are alike, by their sets."""
    rows, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    common = _intersections(hashes, first, rows)[at[: len(left)], at[len(left) :]]
    size = np.diff(first)
    return common >= threshold * (size[left] + size[right] - common) - 1e-6


def _link_batches(least: dict[int, int], threshold: float):
    """Links of every set of a block, and a spanning forest of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key", "block"]):
            table = table.combine_chunks()
            key, block, side, cross, own, copies = _columns(
                table, "key", "block", "side", "cross", "set_id", "copies"
            )
            group = _ids(key, block)
            texts = pa.concat_arrays(table.column("text").cast(pa.large_string()).chunks)
            for k in np.unique(group):
                at = slice(*np.searchsorted(group, [k, k + 1]))
                parts, sizes = [], [np.zeros(1, np.int64)]
                for _, _, data, offsets in text_slices(texts[at]):
                    h, f = shingle_sets(data, offsets)
                    parts.append(h)
                    sizes.append(np.diff(f))
                hashes, first = np.concatenate(parts), np.cumsum(np.concatenate(sizes))
                names = own[at]
                # a repeated row, or another text under the same id, is not this set
                valid = set_names(hashes, first) == names
                _, once = np.unique(np.stack([names, side[at]]), axis=1, return_index=True)
                rows = np.intersect1d(np.flatnonzero(valid), once)
                sketch = np.zeros((len(names), HASHES), np.uint16)
                sketch[np.diff(first) > 0] = sketches(hashes, first)
                a = np.zeros(len(rows), np.int64)
                links, texts_linked = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
                kept = []
                for i, j in _pairs(a, side[at][rows], cross[at][rows]):
                    i, j = _surviving(sketch, rows[i], rows[j], least)
                    if not len(i):
                        continue
                    alike = _verified(hashes, first, i, j, threshold)
                    i, j = i[alike], j[alike]
                    np.add.at(links, i, copies[at][j])
                    np.add.at(links, j, copies[at][i])
                    np.add.at(texts_linked, i, 1)
                    np.add.at(texts_linked, j, 1)
                    kept.append((i, j))
                if not kept:
                    continue
                root = _roots(len(names), *(np.concatenate(x) for x in zip(*kept)))
                linked = np.flatnonzero(texts_linked)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[linked]),
                        pa.array(names[root[linked]]),
                        pa.array(links[linked]),
                        pa.array(texts_linked[linked]),
                    ],
                    ["u", "v", "n_links", "n_texts"],
                )

    return run


def blocks(rows: DataFrame, size: Column) -> DataFrame:
    """Deals the rows of a key to blocks: one if it has up to BLOCK rows, else one
    for each pair of its chunks (``cross``: pairs are those of different sides)."""
    chunks = F.ceil(size / BLOCK).cast("int")
    chunk = F.when(size > BLOCK, F.pmod(F.xxhash64("set_id", F.lit("chunk")), chunks)).otherwise(0).cast("int")
    rows = rows.withColumn("side", chunk).withColumn("chunks", chunks)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    return rows.select("*", other).withColumns(
        {
            "block": (F.least("side", "other") * F.col("chunks").cast("long") + F.greatest("side", "other")),
            "cross": F.col("side") != F.col("other"),
        }
    ).drop("chunks", "other")


def _sent(rows: DataFrame) -> DataFrame:
    """``rows`` (ids and counts), to be broadcast if they are few: up to some 10 MB."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "block").sortWithinPartitions("key", "block")


def candidate_edges(sets: DataFrame, least: dict[int, int]) -> DataFrame:
    """(u, v): a forest over the pairs of sets that may be alike."""
    bands = sets.select("set_id", "sketch").mapInArrow(_band_batches, "key bigint, set_id bigint")
    named = F.xxhash64("set_id", F.lit("member"))
    buckets = (
        bands.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min("set_id").alias("low"),
            F.max("set_id").alias("high"),
            F.bit_xor(named).alias("members"),
        )
        .where("n > 1")
        # bands in which the same sets met are the same candidates
        .groupBy("n", "low", "high", "members")
        .agg(F.min("key").alias("key"))
        .select("key", "n")
    )
    met = bands.join(buckets, "key")
    dealt = blocks(met, F.col("n")).drop("n").join(sets.select("set_id", "sketch"), "set_id")
    return _dealt(dealt).mapInArrow(_candidate_batches(least), "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """doc_id, class_id, n_links, n_texts of every document.

    A link joins two documents of similarity ``threshold`` or more; a class is what
    links connect, named by its least id. ``n_links`` counts linked documents,
    ``n_texts`` linked sets other than the own.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    least = least_matches(threshold, tolerance)
    sketched = rows.mapInArrow(_sketch_batches, f"doc_id {id_type}, set_id bigint, sketch binary")
    sketched = settled(sketched)
    named = sketched.select("doc_id", "set_id")
    sets = settled(
        sketched.where("set_id is not null and doc_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"))
    )
    close = settled(components(candidate_edges(sets, least)))
    # what a hot key is joined with is settled first: a join with shuffles of its own
    # splits the rows of the key, one fused with a grouping by it cannot
    sizes = settled(close.groupBy("root").agg(F.count("*").alias("n")))
    members = (
        close.join(sizes, "root")
        .select(F.col("root").alias("key"), F.col("node").alias("set_id"), "n")
        .join(sets.select("set_id", "rep", "copies"), "set_id")
    )
    members = settled(members)
    dealt = blocks(rows.withColumnRenamed("doc_id", "rep").join(_sent(members), "rep"), F.col("n"))
    found = settled(
        _dealt(dealt.drop("n", "rep")).mapInArrow(
            _link_batches(least, threshold), "u bigint, v bigint, n_links bigint, n_texts bigint"
        )
    )
    roots = components(found.where("u != v").select("u", "v"))
    links = found.groupBy(F.col("u").alias("set_id")).agg(
        F.sum("n_links").alias("n_links"), F.sum("n_texts").alias("n_texts")
    )
    placed = sets.select("set_id", "rep", "copies").join(
        roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left"
    ).withColumn("root", F.coalesce("root", "set_id"))
    placed = settled(placed)
    classes = settled(placed.groupBy("root").agg(F.min("rep").alias("class_id")))
    per_set = placed.join(classes, "root").join(links, "set_id", "left").select(
        "set_id",
        "class_id",
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
    )
    return named.join(settled(per_set), "set_id", "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_texts", F.lit(0))).otherwise(0).alias("n_texts"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents that are the least of their class, with their own columns.

    Of repeated rows (same id) one stays; rows without an id all stay.
    """
    found = near_duplicates(docs, **options).where("doc_id is not null")
    per_id = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count("*").alias("n"))
    per_id = settled(per_id.where("n > 1 or class_id != doc_id"))
    doc_id = options.get("doc_id", "doc_id")
    gone = per_id.where("class_id != doc_id").select(F.col("doc_id").alias(doc_id))
    left = docs.join(_sent(gone), doc_id, "left_anti")
    if per_id.where("class_id = doc_id").isEmpty():
        return left.select(*docs.columns)
    unnamed = left.where(F.col(doc_id).isNull())
    return left.where(F.col(doc_id).isNotNull()).dropDuplicates([doc_id]).union(unnamed).select(*docs.columns)
