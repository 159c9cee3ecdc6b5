"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every suffix is ordered through its first ``WIDTH`` bytes only; suffixes that are
then still equal are the repeated windows. The passes, most significant digit first:

0. Copies of a whole text are known by their hashes; the first of them is sorted.
1. The first digit of a suffix is the least (by hash) of the ``SEED``-byte strings in
   its window. Equal windows have equal digits at equal places, and neighbouring
   suffixes mostly share one, so a digit stands for a run of some 16 suffixes. Digits
   are dealt to buckets; one that only one document has ends the sorting of its
   suffixes. Blocks of documents get back one bit for each digit.
2. The second digit is the run itself, byte for byte. Equal runs fall together; what
   is left of a run's copies is its first document.
3. Runs that differ under an equal first digit are taken apart into suffixes, which
   are sorted by eight bytes at a time; suffixes that are alone leave after each pass.

A first digit of more than ``HOT_DOCUMENTS`` documents is not a bucket's work: its
runs are taken apart at once and dealt by the whole window. Within a block equal runs
are settled before they are shipped.

Defined results: a null text is empty; texts shorter than the window lose nothing; a
null id is after all others and its text removes nothing elsewhere; rows of equal id
do not remove from each other; repeated rows are answered alike; an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rowharbor.llm.scan import mix, ranges, single_groups, text_slices, whole_groups
from rowharbor.llm.tables import settled, text_bytes

WIDTH = 50
SEED = 20
PLACES = WIDTH - SEED + 1
BLOCK_BYTES = 8 << 20
SLICE = 1 << 18
LONGEST_SLICE = 1 << 22
HOT_DOCUMENTS = 4_000
LAST_ID = (1 << 63) - 1


def _longs(data: np.ndarray, at: int | np.ndarray, order: str = "<u8") -> np.ndarray:
    """8-byte values at every byte place of ``data`` (which must be padded)."""
    view = np.ndarray((len(data) - 7,), order, data, 0, (1,))
    return view[at:] if isinstance(at, int) else view[at]


def _runs(data: np.ndarray, offsets: np.ndarray):
    """Runs of windows with one first digit: (first window, windows, digit)."""
    n = len(data) - WIDTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
    m = len(data) - SEED + 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    digit = _longs(padded, 0)[:m] * np.uint64(0x9E3779B97F4A7C15)
    digit ^= digit >> np.uint64(31)
    digit += _longs(padded, 8)[:m]
    digit *= np.uint64(0xD6E8FEB86659FD93)
    digit ^= digit >> np.uint64(29)
    digit += _longs(padded, SEED - 8)[:m]
    digit = mix(digit)
    least = (digit & ~np.uint64((1 << 23) - 1)) | np.arange(m, dtype=np.uint64)
    span = 1
    while span * 2 <= PLACES:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = PLACES - span
    least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least & np.uint64((1 << 23) - 1)).astype(np.int64)
    for cut in offsets[1:-1].tolist():
        place[max(cut - WIDTH + 1, 0) : cut] = -1
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    count = np.diff(np.append(first, n))
    inside = place[first] >= 0
    first, count = first[inside], count[inside]
    return first, count, digit[place[first]]


def _block_runs(texts: pa.Array):
    """Of all texts of a block: (row, first window in the text, windows, digit)."""
    rows, firsts, counts, digits = [], [], [], []
    for row, end, data, offsets in text_slices(texts, SLICE):
        for begin in range(0, max(len(data) - WIDTH + 1, 1), LONGEST_SLICE):
            part = data[begin : begin + LONGEST_SLICE + WIDTH - 1]
            first, count, digit = _runs(part, offsets if end - row > 1 else offsets[[0, -1]])
            owner = np.searchsorted(offsets, first + begin, side="right") - 1
            rows.append(row + owner)
            firsts.append(first + begin - offsets[owner])
            counts.append(count)
            digits.append(digit)
    if not rows:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(x) for x in (rows, firsts, counts, digits))


def _doc_ids(table) -> np.ndarray:
    return table.column("doc_id").fill_null(LAST_ID).to_numpy()


def _as_array(column) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _block_digits(rows: np.ndarray, digits: np.ndarray, ids: np.ndarray, n_buckets: int):
    """The block's distinct digits, in the order of (bucket, digit), the number of
    documents each is in, and where each bucket begins."""
    order = np.lexsort((ids[rows], digits))
    d, owner = digits[order], ids[rows][order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (owner[1:] != owner[:-1])
    distinct, documents = np.unique(d[new], return_counts=True)
    bucket = (distinct % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return distinct[order], documents[order], np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def _ship_digits(n_buckets: int):
    """Pass 1, from blocks to buckets: six bytes for each digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in single_groups(batches, "block"):
            texts = _as_array(table.column("text").cast(pa.large_string()))
            rows, _, _, digits = _block_runs(texts)
            distinct, documents, begins = _block_digits(rows, digits, _doc_ids(table), n_buckets)
            packed = (distinct // np.uint64(n_buckets)).view(np.uint8).reshape(-1, 8)[:, :6]
            counts = np.minimum(documents, 255).astype(np.uint8)
            full = np.flatnonzero(np.diff(begins))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(full, pa.int32()),
                    "block": pa.array(np.full(len(full), table.column("block")[0].as_py()), pa.int32()),
                    "digits": pa.array([packed[begins[b] : begins[b + 1]].tobytes() for b in full], pa.binary()),
                    "documents": pa.array([counts[begins[b] : begins[b + 1]].tobytes() for b in full], pa.binary()),
                }
            )

    return run


def _answer_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 1, back from a bucket: which digits of a block several documents have."""
    for table in single_groups(batches, "bucket"):
        shipped = table.column("digits").to_pylist()
        lengths = np.array([len(d) // 6 for d in shipped])
        six = np.frombuffer(b"".join(shipped), np.uint8).reshape(-1, 6)
        digits = np.zeros((len(six), 8), np.uint8)
        digits[:, :6] = six
        counts = np.frombuffer(b"".join(table.column("documents").to_pylist()), np.uint8)
        _, number = np.unique(digits.view(np.uint64).reshape(-1), return_inverse=True)
        total = np.bincount(number, counts)[number] if len(number) else np.empty(0)
        again, hot = total > 1, total > HOT_DOCUMENTS
        ends = np.cumsum(lengths)
        out = [[], [], [], []]
        for block, a, b in zip(table.column("block").to_pylist(), ends - lengths, ends):
            if again[a:b].any():
                out[0].append(block)
                out[1].append(table.column("bucket")[0].as_py())
                out[2].append(np.packbits(again[a:b]).tobytes())
                out[3].append(np.packbits(hot[a:b]).tobytes() if hot[a:b].any() else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
            ["block", "bucket", "again", "hot"],
        )


def _bits(answers: pa.Table, begins: np.ndarray, name: str) -> np.ndarray:
    out = np.zeros(begins[-1], bool)
    for bucket, packed in zip(answers.column("bucket").to_pylist(), answers.column(name).to_pylist()):
        if packed is not None:
            a, b = begins[bucket], begins[bucket + 1]
            out[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
    return out


RUN_FIELDS = "key int, digit int, block int, doc_id bigint, text_hash int, start int, run binary, covered int"
_RUN_SCHEMA = pa.schema(
    [
        ("key", pa.int32()),
        ("digit", pa.int32()),
        ("block", pa.int32()),
        ("doc_id", pa.int64()),
        ("text_hash", pa.int32()),
        ("start", pa.int32()),
        ("run", pa.binary()),
        ("covered", pa.int32()),
    ]
)


def _ship_runs(n_buckets: int, n_keys: int):
    """Pass 2, from blocks: the runs whose digit several documents have. Copies of a
    run in later documents of the block are settled here (``covered`` bytes)."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows or not answers.num_rows:
            return _RUN_SCHEMA.empty_table()
        number = block.column("block")[0].as_py()
        told = answers.column("copies").is_valid()
        copies = answers.filter(told).column("copies").to_pylist()
        answers = answers.filter(pc.invert(told))
        texts = _as_array(block.column("text").cast(pa.large_string()))
        ids = _doc_ids(block)
        rows, first, count, digits = _block_runs(texts)
        distinct, _, begins = _block_digits(rows, digits, ids, n_buckets)
        again, hot = _bits(answers, begins, "again"), _bits(answers, begins, "hot")
        by_digit = np.argsort(distinct)
        at = by_digit[np.searchsorted(distinct[by_digit], digits)]
        names = block.column("text_hash").to_numpy()
        known = {(c["doc_id"], c["text_hash"]) for listed in copies for c in listed}
        copy = np.array([pair in known for pair in zip(ids.tolist(), names.tolist())], bool)
        keep = again[at] & ~copy[rows]
        rows, first, count, digits, hot = rows[keep], first[keep], count[keep], digits[keep], hot[at][keep]
        if hot.any():  # runs of very common digits are taken apart at once
            parts = np.where(hot, count, 1)
            inner = ranges(np.zeros(len(parts), np.int64), parts)
            spread = lambda x: np.repeat(x, parts)
            rows, digits, hot = spread(rows), spread(digits), spread(hot)
            first, count = spread(first) + inner, np.where(hot, 1, spread(count))
        raw = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.empty(0, np.uint8)
        size = count + WIDTH - 1
        begin = offsets[rows] + first
        joined = data[ranges(begin, size)]
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        runs = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(joined)]
        ).cast(pa.binary())
        code = runs.dictionary_encode().indices.to_numpy()
        owner = ids[rows]
        least = np.full(code.max(initial=-1) + 1, LAST_ID)
        np.minimum.at(least, code, owner)
        covered = np.where(owner > least[code], size, 0)
        key = (mix(digits) % np.uint64(n_keys)).astype(np.int64)
        if hot.any():
            h = np.flatnonzero(hot)
            whole = np.zeros(len(h), np.uint64)
            padded = np.concatenate([joined, np.zeros(8, np.uint8)])
            for k in (0, 8, 16, 24, 32, 40, WIDTH - 8):
                whole = mix(whole + _longs(padded, ends[h] + k))
            key[h] = (whole % np.uint64(n_keys)).astype(np.int64)
            digits = digits.copy()
            digits[h] = whole
        settled = covered > 0
        # nothing is left to compare: dealt by block, so that no digit heaps them up
        key[settled] = number % n_keys
        runs = _emptied(runs, settled)
        found = [
            pa.array(key, pa.int32()),
            pa.array((digits & np.uint64(0x7FFFFFFF)).astype(np.int32)),
            pa.array(np.full(len(rows), number), pa.int32()),
            pa.array(owner),
            pa.array(names[rows]),
            pa.array(first, pa.int32()),
            runs,
            pa.array(covered, pa.int32()),
        ]
        # copies of a whole text are settled as they are
        lengths = np.diff(offsets)
        whole = np.flatnonzero(copy & (lengths >= WIDTH))
        nothing = np.zeros(len(whole), np.int32)
        copied = [
            pa.array(nothing + np.int32(number % n_keys)),
            pa.array(nothing),
            pa.array(nothing + np.int32(number)),
            pa.array(ids[whole]),
            pa.array(names[whole]),
            pa.array(nothing),
            pa.nulls(len(whole), pa.binary()),
            pa.array(lengths[whole], pa.int32()),
        ]
        return pa.concat_tables(
            [pa.Table.from_arrays(x, schema=_RUN_SCHEMA) for x in (found, copied)]
        ).combine_chunks()

    return run


def _emptied(runs: pa.Array, settled: np.ndarray) -> pa.Array:
    """``runs`` with null where settled: their bytes need not travel."""
    return pc.if_else(pa.array(settled), pa.scalar(None, pa.binary()), runs)


def _equal_windows(data: np.ndarray, start: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Pass 3: which windows of ``data`` a smaller owner has as well. Sorted by eight
    bytes at a time; windows that are alone or of one owner leave after each pass."""
    covered = np.zeros(len(start), bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at, group = np.arange(len(start)), np.zeros(len(start), np.int64)
    depths = (0, 8, 16, 24, 32, 40, WIDTH - 8)
    for depth in depths:
        digit = _longs(padded, start[at] + depth, ">u8")
        order = np.lexsort((digit, group))
        at, digit, group = at[order], digit[order], group[order]
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        group = np.cumsum(new) - 1
        if not len(at):
            return covered
        first = np.flatnonzero(new)
        low = np.minimum.reduceat(owner[at], first)
        high = np.maximum.reduceat(owner[at], first)
        if depth == depths[-1]:
            covered[at] = owner[at] > low[group]
        on = (low < high)[group]
        at, group = at[on], group[on]
    return covered


SPAN_FIELDS = "block int, doc_id bigint, text_hash int, start int, covered int"


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes 2 and 3 in a bucket: spans of bytes that an earlier document has."""
    for table in whole_groups(batches, ["key"]):
        covered = table.column("covered").to_numpy()
        names = ("block", "doc_id", "text_hash", "start")
        columns = [table.column(c).to_numpy() for c in names]
        known = covered > 0
        parts = [[c[known] for c in columns] + [covered[known]]]
        open_ = np.flatnonzero(~known)
        if len(open_):
            encoded = _as_array(table.column("run").take(pa.array(open_))).dictionary_encode()
            code, words = encoded.indices.to_numpy(), encoded.dictionary
            owner = columns[1][open_]
            least = np.full(len(words), LAST_ID)
            np.minimum.at(least, code, owner)
            digit = np.empty(len(words), np.int32)
            digit[code] = table.column("digit").to_numpy()[open_]
            ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
            data = np.frombuffer(words.buffers()[2], np.uint8)
            later = owner > least[code]
            size = np.diff(ends)
            parts.append([c[open_[later]] for c in columns] + [size[code[later]]])
            # different runs under one digit: compare their windows
            _, number, same = np.unique(digit, return_inverse=True, return_counts=True)
            several = np.flatnonzero(same[number] > 1)
            windows = size[several] - WIDTH + 1
            run_of = np.repeat(several, windows)
            inner = ranges(np.zeros(len(several), np.int64), windows)
            hit = _equal_windows(data, ends[run_of] + inner, least[run_of])
            run_of, inner = run_of[hit], inner[hit]
            # consecutive windows of a run are one span
            new = np.ones(len(run_of), bool)
            new[1:] = (run_of[1:] != run_of[:-1]) | (inner[1:] != inner[:-1] + 1)
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(run_of)) - 1 if len(begin) else begin
            span_run, span_at = run_of[begin], inner[begin]
            span_size = inner[last] - inner[begin] + WIDTH
            first = np.flatnonzero(~later)
            order = np.argsort(code[first], kind="stable")
            first = first[order]
            a, b = np.searchsorted(code[first], span_run), np.searchsorted(code[first], span_run, side="right")
            rows = first[ranges(a, b - a)]
            part = [c[open_[rows]] for c in columns]
            part[3] = part[3] + np.repeat(span_at, b - a)
            parts.append([*part, np.repeat(span_size, b - a)])
        merged = [np.concatenate(x) for x in zip(*parts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(merged[0], pa.int32()), pa.array(merged[1]), pa.array(merged[2]), pa.array(merged[3], pa.int32()), pa.array(merged[4], pa.int32())],
            ["block", "doc_id", "text_hash", "start", "covered"],
        )


_KEPT_FIELDS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,n_bytes:bigint>>, kept binary"


def _cut_texts(block: pa.Table, spans: pa.Table) -> pa.Table:
    """Removes the spans of each text of a block."""
    owner, name = spans.column("doc_id").to_numpy(), spans.column("text_hash").to_numpy()
    start, covered = spans.column("start").to_numpy().astype(np.int64), spans.column("covered").to_numpy().astype(np.int64)
    order = np.lexsort((start, name, owner))
    owner, name, start, covered = owner[order], name[order], start[order], covered[order]
    texts = _as_array(block.column("text").cast(pa.large_string())).cast(pa.large_binary()).fill_null(b"")
    ids, names = _doc_ids(block), block.column("text_hash").to_numpy()
    low, high = np.searchsorted(owner, ids), np.searchsorted(owner, ids, side="right")
    out: list[list] = [[] for _ in range(6)]
    for k in range(len(texts)):
        data = texts[k].as_buffer()
        a, b = low[k], high[k]
        mine = slice(a, b) if b == a or (name[a] == name[b - 1] == names[k]) else np.arange(a, b)[name[a:b] == names[k]]
        begins, ends = start[mine], start[mine] + covered[mine]
        reach = np.maximum.accumulate(ends) if len(ends) else ends
        new = np.ones(len(begins), bool)
        new[1:] = begins[1:] > reach[:-1]
        first = np.flatnonzero(new)
        begins, ends = begins[first], reach[np.append(first[1:], len(reach)) - 1] if len(first) else ends
        digest, kept, at = hashlib.sha256(), [], 0
        view = memoryview(data)
        for i, j in zip(begins.tolist(), ends.tolist()):
            kept.append(view[at:i])
            at = j
        kept.append(view[at:])
        for piece in kept:
            digest.update(piece)
        out[0].append(len(data))
        out[1].append(int((ends - begins).sum()))
        out[2].append(len(begins))
        out[3].append(digest.hexdigest())
        out[4].append([{"start": i, "n_bytes": j - i} for i, j in zip(begins.tolist(), ends.tolist())])
        out[5].append(b"".join(kept) if len(begins) else bytes(view))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("n_bytes", pa.int64())]))
    return pa.Table.from_arrays(
        [
            block.column("doc_id").combine_chunks(),
            pa.array(out[0], pa.int64()),
            pa.array(out[1], pa.int64()),
            pa.array(out[2], pa.int64()),
            pa.array(out[3], pa.string()),
            pa.array(out[4], span_type),
            pa.array(out[5], pa.binary()),
        ],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
    )


def _copies(rows: DataFrame) -> DataFrame:
    """For each block, the ids whose whole text an earlier document has."""
    body = F.coalesce("text", F.lit(""))
    named = rows.select(
        "block",
        "text_hash",
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"),
        F.xxhash64(body, F.lit(1)).alias("name"),
        F.crc32(body.cast("binary")).alias("sum"),
        F.octet_length(body).alias("size"),
    ).where(F.col("size") >= WIDTH)
    same = ["name", "sum", "size"]
    least = named.groupBy(*same).agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    # settled, so that the join has shuffles of its own and a text that many have is split
    least = settled(least.where("n > 1").drop("n"))
    later = named.join(least, same).where("doc_id > least")
    return later.groupBy("block").agg(F.collect_list(F.struct("doc_id", "text_hash")).alias("copies"))


def without_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans and kept (the remaining
    bytes) of every document: a byte goes if a window over it also starts in a
    document of a smaller id."""
    size = text_bytes(docs, text)
    n_blocks = max(8, -(-size // block_bytes))
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.hash(text).alias("text_hash"),
        # by the text too: rows that share an id are dealt like others
        F.pmod(F.xxhash64(F.col(doc_id), F.hash(text), F.lit("block")), F.lit(n_blocks)).cast("int").alias("block"),
    )
    copies = _copies(rows)
    # read three times, shuffled once: the exchange is the same each time
    rows = rows.repartition(n_blocks, "block")
    digits = (
        rows.sortWithinPartitions("block")
        .mapInArrow(_ship_digits(n_blocks), "bucket int, block int, digits binary, documents binary")
        .repartition(n_blocks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_answer_digits, "block int, bucket int, again binary, hot binary")
    )
    answers = digits.withColumn("copies", F.lit(None).cast("array<struct<doc_id:bigint,text_hash:int>>")).unionByName(
        copies, allowMissingColumns=True
    )
    n_keys = n_blocks * 4
    spans = (
        rows.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_ship_runs(n_blocks, n_keys), RUN_FIELDS)
        .repartition(n_blocks, "key")
        .sortWithinPartitions("key")
        .mapInArrow(_compare_runs, SPAN_FIELDS)
    )
    return rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(_cut_texts, _KEPT_FIELDS)
