"""Numpy views over the texts of an Arrow batch: slices, words and hashes.

Everything works on the bytes Arrow already holds; a slice is a few megabytes, so
that the arrays made from it stay small whatever the batch holds.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a one-to-one mapping)."""
    v = values ^ (values >> np.uint64(32))
    v = v * _MULTIPLIER
    v ^= v >> np.uint64(29)
    v *= _ODD
    v ^= v >> np.uint64(32)
    return v


def text_slices(
    texts: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``limit``
    bytes; a longer text is alone in its slice. Nulls are empty texts."""
    column = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        base = offsets[first]
        yield first, end, data[base : offsets[end]], offsets[first : end + 1] - base
        first = end


@functools.lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x5851F42D4C957F2D
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.full(1 << bits, base, np.uint64)
        down = np.full(1 << bits, inverse, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def span_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of ``values`` (uint64)."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(max(int(len(values)).bit_length(), 22))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that no offset cuts."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cuts = offsets[(offsets > 0) & (offsets < len(inside))]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[cuts] = inside[cuts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def ascii_words(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a slice and, per text, where its words begin.

    A word is a run of digits, a-z (A-Z are lower-cased) and characters beyond
    ASCII; in UTF-8 all bytes of the latter are 128 or more, so bytes suffice.
    """
    lowered = _LOWER[data]
    starts, ends = spans(_WORD[lowered], offsets)
    hashes = span_hashes(_BYTE_VALUES[lowered], starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column


def byte_lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows that come sorted by ``keys``."""
    waiting: list[pa.RecordBatch] = []
    last = None

    def named(batch: pa.RecordBatch, row: int):
        return tuple(batch.column(batch.schema.get_field_index(k))[row].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting and named(batch, 0) != last:
            yield pa.Table.from_batches(waiting)
            waiting = []
        end = named(batch, batch.num_rows - 1)
        if named(batch, 0) == end:
            waiting.append(batch)
        else:
            cut = np.zeros(batch.num_rows, bool)
            for k, value in zip(keys, end):
                column = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
                cut |= column != value
            first = int(np.flatnonzero(cut)[-1]) + 1
            yield pa.Table.from_batches([*waiting, batch.slice(0, first)])
            waiting = [batch.slice(first)]
        last = end
    if waiting:
        yield pa.Table.from_batches(waiting)


def single_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The tables of one group each, of rows that come sorted by ``key``."""
    for table in whole_groups(batches, [key]):
        values = table.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
