"""Packing documents into sequences of a fixed number of tokens.

1. Every whole text is turned into token ids, closed by an end id and cut into pieces
   of a window; the last piece of a document is shorter. Pieces are written once, with
   their number among those of their length in the task.
2. The driver sees the histogram of lengths, as long as the window. Non-negative least
   squares choose how often which combination of few lengths fills a window; what is left
   is packed greedily, and a piece is cut where a window would stay open
   (``combinations.py``).
3. The plan, a few thousand entries, goes to all tasks. A piece's length and number say
   where it goes, so no piece moves and no group of equal lengths is ever gathered.

Null and empty texts have the end id alone. Null and repeated doc_ids are documents of
their own; so are equal texts. An empty table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rowharbor.llm.combinations import packing_plan
from rowharbor.llm.tokens import Ids
from rowharbor.work_dir import work_dir

WINDOW = 2048
END_ID = 1
#: Counts by task and length are broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_ROWS = 500_000
#: Bytes of ids that a task hands on at once.
HANDED_ON = 8 << 20


@functools.lru_cache(1)
def _ids(path: str) -> Ids:
    return Ids(path)


def pieces(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of at most ``window`` ids: (doc_id, start, length, doc_tokens, ids as
    4-byte numbers, task, nth of its length in the task), written once."""
    spark = docs.sparkSession
    closing = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType(
        [rows.schema["doc_id"]]
        + [T.StructField(name, kind) for name, kind in (
            ("start", T.LongType()), ("length", T.LongType()), ("doc_tokens", T.LongType()),
            ("ids", T.BinaryType()), ("task", T.LongType()), ("nth", T.LongType()))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(window + 1, dtype=np.int64)
        encode = _ids(tokenizer).of
        for batch in batches:
            which, found, size = [], [], 0
            for i, value in enumerate(batch.column(1)):
                ids = encode(value.as_py() or "") + closing
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    piece = ids[4 * start : 4 * (start + length)]
                    found.append((start, length, total, piece, task, int(seen[length])))
                    which.append(i)
                    seen[length] += 1
                    size += len(piece)
                    if size >= HANDED_ON:
                        yield handed(batch, which, found)
                        which, found, size = [], [], 0
            if found:
                yield handed(batch, which, found)

    def handed(batch, which, found) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), *columns], names=schema.names)

    path = work_dir(spark, "pieces")
    rows.mapInArrow(cut, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def packed(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
    doc_id: str = "doc_id", text: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Where every id goes: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, ids as 4-byte numbers), one row for each piece of a sequence. Sequences
    are numbered from 0, and their pieces follow each other from offset 0. Without
    ``with_ids`` the ids stay behind."""
    settled = pieces(docs, tokenizer, window, end_id, doc_id, text)
    counts = settled.groupBy("task", "length").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    based = counts.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    path = work_dir(docs.sparkSession, "lengths")
    based.write.parquet(path)
    based = docs.sparkSession.read.schema("task LONG, length LONG, n LONG, base LONG").parquet(path)
    few = based.count() <= BROADCAST_ROWS
    histogram = {r.length: r.n for r in based.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = packing_plan(histogram, window).arrays()
    bases = based.drop("n")
    numbered = (
        settled.join(F.broadcast(bases) if few else bases, ["task", "length"])
        .withColumn("number", F.col("nth") + F.col("base"))
        .select("doc_id", "start", "length", "doc_tokens", "ids", "number")
    )
    schema = T.StructType(
        [numbered.schema["doc_id"]]
        + [T.StructField(name, T.LongType()) for name in (
            "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
        + [T.StructField("ids", T.BinaryType())] * with_ids
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield placed(batch, plan, schema.names)

    return numbered.mapInArrow(place, schema)


#: Numbers of one length stay below this; a length and a number make one key.
_NUMBERS = 1 << 48


def placed(batch: pa.RecordBatch, plan: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    """The pieces of a batch at their places, cut where the plan cuts them."""
    keys = plan["length"] * _NUMBERS + plan["first"]
    row = np.arange(batch.num_rows)
    start, length, _, number = (batch.column(i).to_numpy() for i in (1, 2, 3, 5))
    skip = np.zeros(batch.num_rows, dtype=np.int64)
    out: list[tuple[np.ndarray, ...]] = []
    while len(row):
        entry = np.searchsorted(keys, length * _NUMBERS + number, side="right") - 1
        nth = number - plan["first"][entry]
        head = plan["head"][entry]
        out.append((row, skip, head, plan["sequence"][entry] + nth, plan["offset"][entry]))
        more = plan["rest"][entry] > 0
        row, skip, nth, entry = row[more], (skip + head)[more], nth[more], entry[more]
        length, number = plan["rest"][entry], plan["rest_first"][entry] + nth
    row, skip, head, sequence, offset = (np.concatenate(c) for c in zip(*out, strict=True))
    whole = batch.column(4)
    cut = [whole[int(r)].as_py()[4 * s : 4 * (s + n)] for r, s, n in zip(row, skip, head, strict=True)]
    take = pa.array(row)
    columns = [
        batch.column(0).take(take),
        pa.array(start[row] + skip),
        pa.array(head),
        pa.array([zlib.crc32(ids) for ids in cut], pa.int64()),
        batch.column(3).take(take),
        pa.array(sequence),
        pa.array(offset),
        pa.array(cut, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns[: len(names)], names=names)


def sequences(found: DataFrame) -> DataFrame:
    """The sequences themselves: (sequence_id, tokens, ids as 4-byte numbers, doc_ids in
    order of their pieces). A sequence's pieces are at most a window of ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        found.groupBy("sequence_id")
        .agg(F.sum("length").alias("tokens"), ordered.alias("parts"))
        .select(
            "sequence_id",
            "tokens",
            F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"),
            F.col("parts.doc_id").alias("doc_ids"),
        )
    )
