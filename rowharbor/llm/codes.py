"""Compressing vectors to one byte for each of their parts, by ball k-means.

A vector is cut into equal parts, and every part position has a codebook. In a round
each part is assigned to its nearest entry, then each entry moves to the mean of its
parts. After the first assignment the work of a round is bounded by balls:

* the parts that an entry holds lie in a ball around it; only entries whose distance is
  at most twice the ball's radius are its neighbours, and no other can take a part;
* a part nearer to its entry than half way to the entry's nearest neighbour is in the
  stable core and is not looked at;
* the others lie in rings between half the distances to the entry's first, second, third
  ... neighbour; a part is compared with the neighbours inside its ring only.

All numbers are whole, so the result is that of comparing everything with everything.
Codebooks are small (parts x entries) and go to all tasks; a task hands back sums for
each entry. Every round's assignment is written to the shared folder.

Rows whose vector is null or holds null or non-finite components are dropped; null labels
count as one label; a null vec_id comes last. Rows that repeat a vec_id are rows of
their own, but count once among the first entries, with the least vector. Vectors
shorter than the longest, and a length that the parts do not divide, end in zeros. An
empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowharbor.llm.vectors import matrix, whole_vectors
from rowharbor.work_dir import work_dir

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Labels' sums are broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_ROWS = 500_000

CODED = "vec_id LONG, label {label}, ints ARRAY<INT>, code BINARY"


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Index of each row's nearest entry, the lowest of equals."""
    best, at = None, np.zeros(len(x), dtype=np.int64)
    for k, entry in enumerate(book):
        distance = ((x - entry) ** 2).sum(axis=1)
        if best is None:
            best = distance
        else:
            nearer = distance < best
            at[nearer], best = k, np.where(nearer, distance, best)
    return at


def nearest_by_balls(x: np.ndarray, book: np.ndarray, held: np.ndarray) -> np.ndarray:
    """As ``nearest``, when ``held`` are the entries that hold the rows so far."""
    between = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    # an entry comes first in its own row, also before its equals
    order = np.argsort(between + 1 - np.eye(len(book), dtype=np.int64), axis=1, kind="stable")
    gaps = np.take_along_axis(between, order, axis=1)
    own = ((x - book[held]) ** 2).sum(axis=1)
    radius = np.zeros(len(book), dtype=np.int64)
    np.maximum.at(radius, held, own)
    neighbours = (gaps <= 4 * radius[:, None]).sum(axis=1)
    best, at = own.copy(), held.copy()
    # rows leave with the first neighbour beyond their ring; cores leave at once
    rows = np.arange(len(x))
    for n in range(1, int(neighbours.max(initial=1))):
        entry = held[rows]
        rows = rows[gaps[entry, n] <= 4 * own[rows]]
        if not len(rows):
            break
        other = order[held[rows], n]
        distance = ((x[rows] - book[other]) ** 2).sum(axis=1)
        nearer = (distance < best[rows]) | ((distance == best[rows]) & (other < at[rows]))
        at[rows[nearer]], best[rows[nearer]] = other[nearer], distance[nearer]
    return at


def _first_entries(rows: DataFrame, entries: int, width: int) -> np.ndarray:
    """Vectors of the ``entries`` smallest ids; a task offers no more than that many."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[bool, int], list[int]] = {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            for i in order:
                key = (ids[i] is None, ids[i] or 0)
                if len(found) >= entries and key not in found and key > max(found):
                    break
                value = batch.column(1)[i].as_py()
                found[key] = min(found.get(key, value), value)
                if len(found) > entries:
                    del found[max(found)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None if null else i for null, i in found], pa.int64()),
                pa.array(list(found.values()), pa.list_(pa.int32())),
            ],
            names=["vec_id", "ints"],
        )

    offered = rows.select(F.col("vec_id").cast("long"), "ints").mapInArrow(least, "vec_id LONG, ints ARRAY<INT>")
    chosen = (
        offered.groupBy("vec_id").agg(F.min("ints").alias("ints"))
        .orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()
    )
    return matrix(pa.array([r.ints for r in chosen], pa.list_(pa.int32())), width)


def _assigned(rows: DataFrame, books: np.ndarray, label: str) -> DataFrame:
    """Rows with the code of their parts; by balls where they have one already."""
    parts, _, per = books.shape
    coded = "code" in rows.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), parts * per).reshape(-1, parts, per)
            code = np.empty((len(x), parts), dtype=np.uint8)
            if coded and len(x):
                held = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
                for p in range(parts):
                    code[:, p] = nearest_by_balls(x[:, p], books[p], held[:, p])
            else:
                for p in range(parts):
                    code[:, p] = nearest(x[:, p], books[p])
            codes = pa.array([row.tobytes() for row in code], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], codes], names=["vec_id", "label", "ints", "code"]
            )

    schema = CODED.format(label=label)
    path = work_dir(rows.sparkSession, "codes")
    rows.mapInArrow(assign, schema).write.parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries moved to the mean of their parts, rounded down; unused ones stay."""
    parts, entries, per = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, per), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0), parts * per).reshape(-1, parts, per)
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                np.add.at(count[p], code[:, p], 1)
                np.add.at(total[p], code[:, p], x[:, p])
        p, k = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p),
                pa.array(k),
                pa.array(count[p, k]),
                pa.array(list(total[p, k]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "total"],
        )

    found = (
        rows.select("ints", "code")
        .mapInArrow(sums, "part LONG, entry LONG, n LONG, total ARRAY<LONG>")
        .groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(per)])
    )
    moved = books.copy()
    for r in found.collect():  # a row for each entry
        moved[r.part, r.entry] = [r[f"t{i}"] // r.n for i in range(per)]
    return moved


def fit(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> tuple[np.ndarray, DataFrame]:
    """Codebooks (parts x entries x components, whole numbers) and all kept rows
    (vec_id, label, ints, code). An entry's number takes one byte, so at most 256."""
    rows = whole_vectors(vectors, vec_id, vector, label)
    kind = rows.schema["label"].dataType.simpleString()
    rows = rows.withColumn("vec_id", F.col("vec_id").cast("long"))
    width = rows.agg(F.max(F.size("ints"))).first()[0] or 0
    per = max(1, -(-width // parts))
    seeds = _first_entries(rows, entries, parts * per)
    books = seeds.reshape(-1, parts, per).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        rows = _assigned(rows, books, kind)
        books = _moved(rows, books)
    return books, _assigned(rows, books, kind)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(vec_id, label, code as hexadecimal text, error, label_error) of all kept rows:
    the squared distance of a row from its entries, and its sum over equal labels."""
    books, rows = fit(vectors, parts, entries, rounds, vec_id, vector, label)
    _, _, per = books.shape
    kind = rows.schema["label"].dataType.simpleString()

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), parts * per).reshape(-1, parts, per)
            texts, error = [], np.zeros(len(x), dtype=np.int64)
            if len(x):
                codes = batch.column(3).to_pylist()
                code = np.frombuffer(b"".join(codes), np.uint8).reshape(-1, parts)
                texts = [c.hex() for c in codes]
                error = ((x - books[np.arange(parts), code]) ** 2).sum(axis=(1, 2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    found = rows.mapInArrow(errors, f"vec_id LONG, label {kind}, code STRING, error LONG")
    path = work_dir(vectors.sparkSession, "label-errors")
    found.groupBy("label").agg(F.sum("error").alias("label_error")).write.parquet(path)
    sums = vectors.sparkSession.read.schema(f"label {kind}, label_error LONG").parquet(path)
    sums = sums.withColumnRenamed("label", "sum_label")
    few = sums.count() <= BROADCAST_ROWS
    return found.join(
        F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("sum_label"))
    ).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
