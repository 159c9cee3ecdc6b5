"""Hard negatives: rows of another label that are nearly as like an anchor as its positives.

1. Rows are ordered along a Hilbert curve, cut into blocks and written as Parquet. The
   first row of a block holds its zone map: the least and the greatest value of every
   dimension, and of the label.
2. An anchor's positives are its best rows of the same label. The block that it stands in
   gives a first bound: the score of the last of them.
3. Interval arithmetic on a zone map bounds the score of any row of a block with the
   anchor. A block is read for a group of anchors only if one of them could find a row
   there that is good enough.
4. Each positive has a window of scores. The block that the anchor stands in bounds each
   window from below, zone maps choose the blocks again, and those are read.

Groups of anchors follow the curve too, so anchors of a group need much the same blocks. A
task reads one block for one group: both are bounded, whatever the data. How many blocks
are read depends on the data: with clusters few, with directions all alike every one.

Scores are inner products of whole numbers (``vectors.py``). Higher ones come first, of
equals the smaller vec_id, a null one last. Rows whose vector or label is null, or with
null or non-finite components, take no part. Repeated rows, also of one vec_id, are rows
of their own; an anchor is never its own positive, its repetition may be. Shorter vectors
end in zeros. An empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rowharbor.llm.hilbert import curve_keys
from rowharbor.llm.vectors import lists, matrix, whole_vectors
from rowharbor.work_dir import work_dir

POSITIVES = 5
NEGATIVES = 3
#: A window is from this to that share of the positive's score, in hundredths.
WINDOW = (50, 95)
#: Rows of a block, anchors of a group, blocks whose zone maps are looked at together.
BLOCK = 2048
GROUP = 1024
PAGE = 4096
#: Blocks of a file, at most.
FILE_BLOCKS = 32
#: Bits of a coordinate on the curve.
BITS = 4
#: Tables of a row for each file are broadcast up to this many rows.
BROADCAST_ROWS = 500_000
#: The last of ids, for null.
NO_ID = (1 << 63) - 1
#: Beyond this, double precision does not hold whole numbers.
EXACT = 1 << 53

_ROW = "anchor BOOLEAN, vec_id LONG, label LONG, ints ARRAY<INT>"
_BLOCK = (
    f"block LONG, place INT, {_ROW}, file LONG, nth LONG, floor LONG, lo ARRAY<INT>, hi ARRAY<INT>, "
    "label_lo LONG, label_hi LONG"
)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def interval(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows between ``lo`` and ``hi`` can have with ``a``."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return scores(up, lo) + scores(down, hi), scores(up, hi) + scores(down, lo)


def best(found: np.ndarray, allowed: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` allowed columns of every row, as rows and columns in order."""
    rows, columns = np.nonzero(allowed)
    order = np.lexsort((ids[columns], -found[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    starts = np.searchsorted(rows, np.arange(len(found)))
    first = np.arange(len(rows)) - starts[rows] < n
    return rows[first], columns[first]


def _written(df: DataFrame, name: str, schema: str | None = None) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def blocks(rows: DataFrame, width: int, n_rows: int, spread: int) -> DataFrame:
    """Rows along the curve, in blocks, written as Parquet; anchors have their number in
    the file and the score of their last positive inside the block."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(3), width)
            cells = np.clip((x + spread) * (1 << BITS) // (2 * spread + 1), 0, (1 << BITS) - 1)
            keys = pa.array(curve_keys(cells, BITS), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "curve"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, blocks_done, anchors_done = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                anchor, ids, label = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                x, n = matrix(part.column(3), width), part.num_rows
                own = np.flatnonzero(anchor)
                floors: list[int | None] = [None] * n
                found = scores(x[own], x)
                alike = (label[own][:, None] == label) & (own[:, None] != np.arange(n))
                r, c = best(found, alike, ids, POSITIVES)
                for i in np.flatnonzero(np.bincount(r, minlength=len(own)) == POSITIVES):
                    floors[own[i]] = int(found[i, c[r == i][-1]])
                nth = np.where(anchor, np.cumsum(anchor) - 1 + anchors_done, 0)
                first = np.arange(n) == 0
                zone = [pa.array([v.tolist()] + [None] * (n - 1), pa.list_(pa.int32())) for v in (x.min(0), x.max(0))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, (file << 24) + blocks_done)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(anchor), pa.array(ids), pa.array(label), lists(x),
                        pa.array(np.full(n, file)),
                        pa.array(nth), pa.array(floors, pa.int64()),
                        *zone,
                        pa.array(np.full(n, label.min()), mask=~first),
                        pa.array(np.full(n, label.max()), mask=~first),
                    ],
                    names=names,
                )
                blocks_done += 1
                anchors_done += len(own)

    names = [column.split()[0] for column in _BLOCK.split(", ")]
    files = max(1, -(-n_rows // (FILE_BLOCKS * BLOCK)), min(-(-n_rows // BLOCK), _partitions(rows)))
    curve = rows.mapInArrow(keyed, f"{_ROW}, curve BINARY").withColumn("salt", F.monotonically_increasing_id())
    ordered = curve.repartitionByRange(files, "curve", "vec_id", "salt").sortWithinPartitions("curve", "vec_id", "salt")
    return _written(ordered.select("anchor", "vec_id", "label", "ints").mapInArrow(cut, _BLOCK), "blocks", _BLOCK)


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _grouped(found: DataFrame) -> DataFrame:
    """Anchors (anchor_key, group, home, anchor_id, label, ints, floor); groups of
    ``GROUP`` anchors follow the curve over all files."""
    own = found.where("anchor")
    per_file = own.groupBy("file").agg(F.max("nth").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = _written(
        per_file.select("file", F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0)).alias("start")), "starts"
    )
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_ROWS else starts
    return own.join(starts, "file").select(
        (F.col("block") * BLOCK + F.col("place")).alias("anchor_key"),
        F.floor((F.col("start") + F.col("nth")) / GROUP).alias("group"),
        F.col("block").alias("home"),
        F.col("vec_id").alias("anchor_id"),
        "label",
        "ints",
        "floor",
    )


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in names]


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    return matrix(table.column(name).combine_chunks(), width)


def _windows(table: pa.Table, name: str, missing: int) -> np.ndarray:
    """A column of at most ``POSITIVES`` numbers as a matrix; missing ones never match."""
    out = np.full((table.num_rows, POSITIVES), missing, dtype=np.int64)
    for i, values in enumerate(table.column(name).to_pylist()):
        out[i, : len(values)] = values
    return out


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _needed(anchors: DataFrame, zones: DataFrame, n_groups: int, pages: int, choose, width: int) -> DataFrame:
    """(group, block) of the blocks that some anchor of the group must read; ``choose``
    says which (anchors, zones as Arrow tables, bounds) -> pairs wanted."""

    def look(key, own: pa.Table, maps: pa.Table) -> pa.Table:
        wanted: list[int] = []
        if own.num_rows and maps.num_rows:
            a = _matrix(own, "ints", width)
            least, most = interval(a, _matrix(maps, "lo", width), _matrix(maps, "hi", width))
            wanted = maps.column("block").combine_chunks().to_numpy()[choose(own, maps, least, most).any(axis=0)].tolist()
        return pa.table({"group": pa.array([key[0].as_py()] * len(wanted), pa.int64()), "block": pa.array(wanted, pa.int64())})

    paged = zones.withColumn("page", F.pmod(F.xxhash64("block"), F.lit(pages)))
    # a zone map is a few hundred bytes, a reading of its block some hundred thousand
    for_groups = paged.withColumn("group", F.explode(_numbers(n_groups)))
    for_pages = anchors.withColumn("page", F.explode(_numbers(pages)))
    pairs = (
        for_pages.groupBy("group", "page")
        .cogroup(for_groups.groupBy("group", "page"))
        .applyInArrow(look, "group LONG, block LONG")
    )
    return _written(pairs, "pairs")


def _read(anchors: DataFrame, found: DataFrame, pairs: DataFrame, visit, schema: str) -> DataFrame:
    """Rows of ``visit`` (anchors of a group, rows of a block) for each pair."""

    def look(key, own: pa.Table, rows: pa.Table) -> pa.Table:
        return visit(key[1].as_py(), own, rows)

    left = anchors.join(pairs, "group")
    right = found.select("block", "place", "vec_id", "label", "ints").join(pairs, "block")
    return left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInArrow(look, schema)


def _number(rows: DataFrame) -> Column:
    """A number for each label: itself, or a hash of 64 bits of any other type."""
    whole = isinstance(rows.schema["label"].dataType, T.IntegralType)
    return F.col("label").cast("long") if whole else F.xxhash64(F.col("label").cast("string"))


def mined(
    vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each anchor (rows where ``anchor`` holds, a condition on ``vec_id``) and each of its
    positives the first negatives inside the positive's window."""
    rows_kept = whole_vectors(vectors, vec_id, vector, label).where("label is not null")
    rows = rows_kept.select(
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
        _number(rows_kept).alias("label"),
        "ints",
    )
    far = F.coalesce(F.array_max(F.transform("ints", F.abs)), F.lit(0))
    n_rows, width, spread = rows.agg(
        F.count("*"), F.max(F.size("ints")), F.percentile_approx(far, 0.99)
    ).first()
    width = max(width or 0, 1)
    found = blocks(rows, width, n_rows, max(spread or 0, 1))
    anchors = _written(_grouped(found), "anchors")
    zones = found.where("place = 0").select("block", "lo", "hi", "label_lo", "label_hi")
    n_groups = (anchors.agg(F.max("group")).first()[0] or 0) + 1
    pages = max(1, -(-zones.count() // PAGE))

    def may_hold_positives(own, maps, least, most):
        labels, floors = own.column("label").to_numpy(), own.column("floor").combine_chunks()
        floor = floors.fill_null(-NO_ID).to_numpy()
        low, high = _columns(maps, "label_lo", "label_hi")
        return (most >= floor[:, None]) & (low <= labels[:, None]) & (high >= labels[:, None])

    def positives_of(block: int, own: pa.Table, rows: pa.Table) -> pa.Table:
        keys, own_labels = _columns(own, "anchor_key", "label")
        places, ids, labels = _columns(rows, "place", "vec_id", "label")
        s = scores(_matrix(own, "ints", width), _matrix(rows, "ints", width))
        floor = own.column("floor").combine_chunks().fill_null(-NO_ID).to_numpy()
        alike = (own_labels[:, None] == labels) & (keys[:, None] != block * BLOCK + places.astype(np.int64)) & (s >= floor[:, None])
        r, c = best(s, alike, ids, POSITIVES)
        return pa.table({"anchor_key": keys[r], "score": s[r, c], "vec_id": ids[c]})

    read = _read(
        anchors, found, _needed(anchors, zones, n_groups, pages, may_hold_positives, width),
        positives_of, "anchor_key LONG, score LONG, vec_id LONG",
    )
    order = (F.col("score").desc(), F.col("vec_id"))
    ranked = read.withColumn("k", F.row_number().over(Window.partitionBy("anchor_key").orderBy(*order)))
    positives = _written(ranked.where(F.col("k") <= POSITIVES), "positives")
    low, high = WINDOW
    listed = F.array_sort(F.collect_list(F.struct("k", "score")))  # at most POSITIVES
    windows = positives.groupBy("anchor_key").agg(listed["score"].alias("scores"))
    seeking = _written(anchors.drop("floor").join(windows, "anchor_key"), "windows")

    def bounds(own: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s = _windows(own, "scores", 0)
        n = np.array([len(v) for v in own.column("scores").to_pylist()])
        given = np.arange(POSITIVES) < n[:, None]
        # low * s <= 100 * n <= high * s, in whole numbers
        return -((-low * s) // 100), (high * s) // 100, given

    def inside(own, rows, s, at_least) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        labels, ids = _columns(rows, "label", "vec_id")
        least, most, given = bounds(own)
        other = own.column("label").to_numpy()[:, None] != labels
        for k in range(POSITIVES):
            from_here = np.maximum(least[:, k], at_least[:, k])
            allowed = other & (s >= from_here[:, None]) & (s <= most[:, k][:, None]) & given[:, k][:, None]
            yield (k, *best(s, allowed, ids, NEGATIVES))

    def floors_of(block: int, own: pa.Table, rows: pa.Table) -> pa.Table:
        own = own.filter(pa.array(_columns(own, "home")[0] == block))
        keys = _columns(own, "anchor_key")[0]
        s = scores(_matrix(own, "ints", width), _matrix(rows, "ints", width))
        floors = np.full((len(keys), POSITIVES), -NO_ID, dtype=np.int64)
        for k, r, c in inside(own, rows, s, floors):
            full = np.flatnonzero(np.bincount(r, minlength=len(keys)) == NEGATIVES)
            last = np.searchsorted(r, full, side="right") - 1
            floors[full, k] = s[full, c[last]] if len(full) else floors[full, k]
        return pa.table({"anchor_key": keys, "floors": pa.array(list(floors), pa.list_(pa.int64()))})

    homes = _written(seeking.select("group", F.col("home").alias("block")).distinct(), "homes")
    floors = _read(seeking, found, homes, floors_of, "anchor_key LONG, floors ARRAY<LONG>")
    seeking = _written(seeking.join(floors, "anchor_key"), "floors")

    def may_hold_negatives(own, maps, least, most):
        labels = own.column("label").to_numpy()
        lows, highs = _columns(maps, "label_lo", "label_hi")
        first, last, given = bounds(own)
        first = np.maximum(first, _windows(own, "floors", -NO_ID))
        any_window = np.zeros(most.shape, dtype=bool)
        for k in range(POSITIVES):
            any_window |= given[:, k, None] & (most >= first[:, k, None]) & (least <= last[:, k, None])
        return any_window & ~((lows == labels[:, None]) & (highs == labels[:, None]))

    def negatives_of(block: int, own: pa.Table, rows: pa.Table) -> pa.Table:
        keys, ids = _columns(own, "anchor_key")[0], _columns(rows, "vec_id")[0]
        s = scores(_matrix(own, "ints", width), _matrix(rows, "ints", width))
        parts = [(keys[r], np.full(len(r), k + 1), s[r, c], ids[c]) for k, r, c in inside(own, rows, s, _windows(own, "floors", -NO_ID))]
        key, k, score, vec = (np.concatenate(v) for v in zip(*parts, strict=True))
        return pa.table({"anchor_key": key, "k": k.astype(np.int32), "score": score, "vec_id": vec})

    read = _read(
        seeking, found, _needed(seeking, zones, n_groups, pages, may_hold_negatives, width),
        negatives_of, "anchor_key LONG, k INT, score LONG, vec_id LONG",
    )
    ranked = read.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_key", "k").orderBy(*order)))
    chosen = ranked.where(F.col("rank") <= NEGATIVES).select(
        "anchor_key", "k", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = positives.select(
        "anchor_key", "k", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    ).join(seeking.select("anchor_key", "anchor_id"), "anchor_key")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return named.join(chosen, ["anchor_key", "k"]).select(
        real("anchor_id"), real("positive_id"), "rank", real("negative_id"), "positive_score", "negative_score"
    )
