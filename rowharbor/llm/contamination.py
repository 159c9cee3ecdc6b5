"""Benchmark decontamination by suffix arrays over the training texts.

Each shard of training texts (a few megabytes of an Arrow batch) gets a suffix
array over its words, ordered as deep as a window is wide. Every suffix of every
benchmark item is looked up in every shard by binary search; what it meets are the
verbatim matches with their places, which are then joined into longest matches.

The benchmark is the query set: it goes to the executors in blocks of a bounded
size, one pass over the texts for each block, and no block is left out.

Defined results: a null or wordless text has no words and no hits; a null or
wordless item has no windows; an item of fewer words than a window is one window;
repeated rows are each answered; a null item id is never named in ``items`` though
its windows hit; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowharbor.llm.scan import ascii_words, ranges, text_column, text_slices
from rowharbor.llm.tables import with_own_columns

WINDOW_WORDS = 10
BLOCK_BYTES = 8 << 20
#: Places of items' windows that are joined at once (of a document, all of them).
MATCHES_AT_ONCE = 1 << 20
MATCHES = "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>"


class Suffixes:
    """The windows of one block of items, as word numbers of the block."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.width = width
        self.item_ids = [i for i, _ in items]
        texts = pa.array([t for _, t in items], pa.large_string())
        hashes, owners, firsts, lengths = [], [], [], []
        base = 0
        for row, _, data, offsets in text_slices(texts):
            found, word_offsets = ascii_words(data, offsets)
            counts = np.diff(word_offsets)
            windows = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
            owners.append(np.repeat(row + np.arange(len(counts)), windows))
            firsts.append(base + ranges(word_offsets[:-1], windows))
            lengths.append(np.repeat(np.minimum(counts, width), windows))
            hashes.append(found)
            base += len(found)
        joined = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.words, ids = np.unique(joined, return_inverse=True)
        ids = ids.astype(np.uint64) + np.uint64(1)
        self.owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        self.first = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
        self.length = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
        item_first = np.full(len(items), 0, np.int64)
        if len(self.owner):
            seen, at = np.unique(self.owner, return_index=True)
            item_first[seen] = self.first[at]
        self.item_word = self.first - item_first[self.owner]
        self.bits = max(int(len(self.words) + 1).bit_length(), 1)
        self.per_key = max(1, min(width, 63 // self.bits))
        full = np.uint64((1 << self.bits) - 1)
        padded = np.concatenate([ids, np.zeros(width, np.uint64)])
        table = padded[self.first[:, None] + np.arange(width)]
        beyond = np.arange(width)[None, :] >= self.length[:, None]
        low = self.packed(np.where(beyond, np.uint64(0), table).T)
        high = self.packed(np.where(beyond, full, table).T)
        both = np.stack([*low, *high], axis=1) if len(self.first) else np.empty((0, 2))
        distinct, self.window = np.unique(both, axis=0, return_inverse=True)
        self.window = self.window.reshape(-1)
        half = distinct.shape[1] // 2
        self.low, self.high = distinct[:, :half].T.copy(), distinct[:, half:].T.copy()
        self.by_window = np.argsort(self.window, kind="stable")
        self.window_offsets = np.searchsorted(
            self.window[self.by_window], np.arange(len(distinct) + 1)
        )
        self.window_length = np.zeros(len(distinct), np.int64)
        self.window_length[self.window] = self.length

    def packed(self, columns: np.ndarray) -> list[np.ndarray]:
        """Word numbers of ``width`` places, several to a 64-bit key."""
        keys = []
        for at in range(0, self.width, self.per_key):
            key = np.zeros(columns.shape[1], np.uint64)
            for place in range(at, at + self.per_key):
                key <<= np.uint64(self.bits)
                if place < self.width:
                    key |= columns[place]
            keys.append(key)
        return keys

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The block's word numbers of other words; 0 for unknown ones."""
        if not len(self.words):
            return np.zeros(len(hashes), np.uint64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, 0).astype(np.uint64)


def bisect(
    lo: np.ndarray, hi: np.ndarray, column: np.ndarray, wanted: np.ndarray, right: bool
) -> np.ndarray:
    """Binary search of each wanted value in its own sorted range of ``column``."""
    lo, hi = lo.copy(), hi.copy()
    last = max(len(column) - 1, 0)
    while len(column) and (lo < hi).any():
        middle = (lo + hi) // 2
        value = column[np.minimum(middle, last)]
        down = (value > wanted) if right else (value >= wanted)
        open_ = lo < hi
        hi = np.where(open_ & down, middle, hi)
        lo = np.where(open_ & ~down, middle + 1, lo)
    return lo


class Shard:
    """Suffix array of some texts, ordered through ``width`` words."""

    def __init__(self, hashes: np.ndarray, word_offsets: np.ndarray, block: Suffixes):
        numbers = block.numbers(hashes)
        width = block.width
        places = np.flatnonzero(numbers)  # a suffix of an unknown word meets nothing
        doc = np.searchsorted(word_offsets, places, side="right") - 1
        left = word_offsets[doc + 1] - places
        padded = np.concatenate([numbers, np.zeros(width, np.uint64)])
        columns = np.stack(
            [np.where(left > k, padded[places + k], np.uint64(0)) for k in range(width)]
        ) if len(places) else np.empty((width, 0), np.uint64)
        keys = block.packed(columns)
        order = np.lexsort(keys[::-1])
        self.keys = [k[order] for k in keys]
        self.places, self.doc = places[order], doc[order]

    def search(self, block: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """The range of the suffix array that begins with each distinct window."""
        n = len(block.window_length)
        ends = []
        for bounds, right in ((block.low, False), (block.high, True)):
            lo, hi = np.zeros(n, np.int64), np.full(n, len(self.places), np.int64)
            for column, wanted in zip(self.keys, bounds):
                below = bisect(lo, hi, column, wanted, False)
                above = bisect(below, hi, column, wanted, True)
                lo, hi = below, above
            ends.append(hi if right else lo)
        return ends[0], np.maximum(ends[0], ends[1])


def _longest(
    doc: np.ndarray, item: np.ndarray, doc_word: np.ndarray, item_word: np.ndarray, n: np.ndarray
) -> list[np.ndarray]:
    """Matches on one diagonal that overlap or touch, joined to the longest."""
    diagonal = doc_word - item_word
    order = np.lexsort((doc_word, diagonal, item, doc))
    doc, item, diagonal = doc[order], item[order], diagonal[order]
    doc_word, item_word, n = doc_word[order], item_word[order], n[order]
    same = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1])
    same &= (diagonal[1:] == diagonal[:-1]) & (doc_word[1:] == doc_word[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], ~same])) if len(doc) else np.empty(0, np.int64)
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    reach = doc_word[last] + n[last] - doc_word[first]
    return [doc[first], item[first], doc_word[first], item_word[first], reach]


def _shard_matches(
    hashes, word_offsets, block: Suffixes, hit: np.ndarray, with_matches: bool
) -> Iterator[list[np.ndarray]]:
    """Marks hit words; gives the longest matches (doc, item, words, length), those of
    some documents at a time: many items may share the windows of a document."""
    shard = Shard(hashes, word_offsets, block)
    lo, hi = shard.search(block)
    met = np.flatnonzero(hi > lo)
    counts = hi[met] - lo[met]
    window = np.repeat(met, counts)
    entry = ranges(lo[met], counts)
    places = shard.places[entry]
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, places, 1)
    np.add.at(steps, places + block.window_length[window], -1)
    hit |= np.cumsum(steps[:-1]) > 0
    if not with_matches:
        return
    order = np.argsort(shard.doc[entry], kind="stable")
    window, places, doc = window[order], places[order], shard.doc[entry][order]
    suffixes = np.diff(block.window_offsets)[window]
    reached = np.cumsum(suffixes)
    at = 0
    while at < len(doc):
        begun = reached[at] - suffixes[at]
        last = max(int(np.searchsorted(reached, begun + MATCHES_AT_ONCE)), at)
        to = int(np.searchsorted(doc, doc[min(last, len(doc) - 1)], side="right"))  # whole documents
        own, many = window[at:to], suffixes[at:to]
        suffix = block.by_window[ranges(block.window_offsets[own], many)]
        yield _longest(
            np.repeat(doc[at:to], many),
            block.owner[suffix],
            np.repeat(places[at:to] - word_offsets[doc[at:to]], many),
            block.item_word[suffix],
            block.length[suffix],
        )
        at = to


def _search_batches(block, text: str, carried: list[str], with_matches: bool):
    """A pass of one block: adds its hits and matches to the carried ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes: Suffixes = block.value
        ids = np.array(suffixes.item_ids, object)
        for batch in batches:
            before = batch.column(batch.schema.get_field_index("_hits"))
            n_words = np.zeros(batch.num_rows, np.int64)
            n_hit = np.zeros(batch.num_rows, np.int64)
            hits: list[bytes] = []
            matches: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for row, end, data, offsets in text_slices(text_column(batch, text)):
                hashes, word_offsets = ascii_words(data, offsets)
                hit = np.zeros(len(hashes), bool)
                for k in range(row, end):
                    if before[k].is_valid and len(packed := before[k].as_py()):
                        at, to = word_offsets[k - row], word_offsets[k - row + 1]
                        bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=to - at)
                        hit[at:to] = bits.astype(bool)
                for found in _shard_matches(hashes, word_offsets, suffixes, hit, with_matches):
                    for doc, item, doc_word, item_word, n in zip(*[f.tolist() for f in found]):
                        matches[row + doc].append(
                            {"item_id": ids[item], "item_word": item_word, "doc_word": doc_word, "n_words": n}
                        )
                n_words[row:end] = np.diff(word_offsets)
                total = np.concatenate([[0], np.cumsum(hit)])
                n_hit[row:end] = total[word_offsets[1:]] - total[word_offsets[:-1]]
                for k in range(end - row):
                    part = hit[word_offsets[k] : word_offsets[k + 1]]
                    hits.append(np.packbits(part).tobytes() if part.any() else b"")
            earlier = batch.column(batch.schema.get_field_index("matches")).to_pylist()
            for k, old in enumerate(earlier):
                if old:
                    matches[k] = old + matches[k]
            columns = {name: batch.column(batch.schema.get_field_index(name)) for name in carried}
            yield pa.RecordBatch.from_pydict(
                columns
                | {
                    "n_words": pa.array(n_words),
                    "n_hit": pa.array(n_hit),
                    "_hits": pa.array(hits, pa.binary()),
                    "matches": pa.array(
                        matches,
                        pa.list_(
                            pa.struct(
                                [
                                    ("item_id", pa.string()),
                                    ("item_word", pa.int32()),
                                    ("doc_word", pa.int32()),
                                    ("n_words", pa.int32()),
                                ]
                            )
                        ),
                    ),
                }
            )

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    with_matches: bool = True,
) -> DataFrame:
    """``docs`` with n_words, n_hit, and ``matches``: per item the longest verbatim
    matches of at least a window, where they begin (in words) and how long they are; none
    of them without ``with_matches``. Repeated items are searched once.

    Columns of ``docs`` named n_words, n_hit, matches or _hits are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")
    ).dropDuplicates(["id", "text"])
    size = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    block_of = F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks))
    rows = docs.drop("n_words", "n_hit", "_hits", "matches")
    carried = rows.columns
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    more = f"n_words bigint, n_hit bigint, _hits binary, matches {MATCHES}"
    schema = f"{names}, {more}" if names else more
    rows = rows.withColumns(
        {
            "n_words": F.lit(0).cast("bigint"),
            "n_hit": F.lit(0).cast("bigint"),
            "_hits": F.lit(None).cast("binary"),
            "matches": F.lit(None).cast(MATCHES),
        }
    )
    for k in range(n_blocks):
        # one block of about block_bytes, not the whole benchmark
        block = [tuple(r) for r in items.where(block_of == k).orderBy("id", "text").collect()]
        sent = spark.sparkContext.broadcast(Suffixes(block, width))
        rows = rows.mapInArrow(_search_batches(sent, text, carried, with_matches), schema)
    return rows.drop("_hits")


def contaminated(found: DataFrame) -> DataFrame:
    """The digest of ``contamination``: items met, their hash, the verdict."""
    ids = F.array_sort(F.array_distinct(F.filter(F.col("matches")["item_id"], lambda i: i.isNotNull())))
    return found.withColumns(
        {
            "n_items": F.coalesce(F.size(ids), F.lit(0)).cast("long"),
            "items_sha256": F.sha2(F.coalesce(F.array_join(ids, ","), F.lit("")), 256),
            "contaminated": F.col("n_hit") > 0,
        }
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents that hold no benchmark window, with their own columns."""

    def clean(own: DataFrame, names: dict[str, str]) -> DataFrame:
        found = contamination(own, benchmark, text=names[text], with_matches=False, **options)
        return found.where("n_hit = 0")

    return with_own_columns(docs, clean)
