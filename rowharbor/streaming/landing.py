"""Continuous landing.

A micro-batch is a landing, named after the stream, its checkpoint and the batch. The
dataset knows the last batch of every checkpoint, so a batch that is done again after a
crash is not written twice.

The checkpoint holds a ledger of its own, ``landings``: a word that names it, and what
had been landed under the stream's name before it began. At every start this is held
against the dataset:

* both agree: the stream goes on;
* the dataset has landings that the checkpoint does not know (it was deleted, or is an
  older copy): it gets a new word, and records that are landed are left out from then on,
  by their position in the log. Nothing is lost, doubled or overwritten;
* the checkpoint has batches that the dataset does not know: the stream refuses to start,
  as rows would be lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rowharbor.operators.lookup import BROADCAST_LIMIT_BYTES
from rowharbor.sinks.dataset import change_rows, read_stored
from rowharbor.sinks.landings import Landings, Refused, landings
from rowharbor.sinks.versions import Versions
from rowharbor.work_dir import files_below

# Default time between flushes.
FLUSH_INTERVAL_MS = 1000

Writer = Callable[[DataFrame, int], None]


def flush_limits(
    max_files: int | None = None, max_bytes: int | None = None
) -> dict[str, str]:
    """Reader options that bound a micro-batch of a file log."""
    limits = {}
    if max_files is not None:
        limits["maxFilesPerTrigger"] = str(max_files)
    if max_bytes is not None:
        limits["maxBytesPerTrigger"] = str(max_bytes)
    return limits


def landing_id(stream: str, batch_id: int) -> str:
    return f"{stream}-{batch_id:012d}"


@dataclass(frozen=True)
class Ledger:
    """What a stream knows when it starts: the owner of its landings, and where the
    furthest positions landed before it are, if there are any."""

    owner: str
    landed_before: str | None


def _last(spark: SparkSession, path: str) -> int:
    """The highest batch number in a directory of the checkpoint, -1 if there is none."""
    names = [f.rsplit("/", 1)[-1] for f, _ in files_below(spark, f"{path}/*")]
    return max((int(n) for n in names if n.isdigit()), default=-1)


def open_ledger(spark: SparkSession, stream: str, checkpoint: str, root: str, positions: bool = True) -> Ledger:
    """Hold the checkpoint against the dataset, as said above. ``positions``: whether the
    log's records say where they stand; without, a stream whose landings are not all its
    checkpoint's is refused."""
    ledger = Versions(spark, f"{checkpoint}/landings")
    now = landings(spark, root)
    done, planned = _last(spark, f"{checkpoint}/commits"), _last(spark, f"{checkpoint}/offsets")
    newest = ledger.newest()
    word, known, begun = ("", [], -1) if newest is None else (newest[1][k] for k in ("word", "known", "begun"))
    owner = f"{stream}/{word}"
    landed = now.batches.get(owner, begun)
    others = sorted(o for o in now.batches if o.startswith(f"{stream}/") and o not in (owner, *known))
    # a batch that was landed, but not yet noted by Spark, comes again with the same rows
    agrees = landed == done or (landed == done + 1 and planned >= landed)
    if newest is not None and not others and agrees:
        return Ledger(owner, _landed_before(checkpoint, word) if known else None)
    if newest is not None and landed < done and not others:
        raise Refused(f"{root} lacks batches {landed + 1} to {done} of {owner}")
    before = sorted({*known, *others, *([owner] if owner in now.batches else [])})
    if before and not positions:
        raise Refused(f"landings of {before} are in {root}, and records have no position")
    word = uuid.uuid4().hex[:12]
    if before:
        _keep_landed(spark, root, now, before, _landed_before(checkpoint, word))
    number = 0 if newest is None else newest[0] + 1
    if not ledger.publish(number, {"word": word, "known": before, "begun": done}):
        raise Refused(f"{checkpoint} is in use")
    return Ledger(f"{stream}/{word}", _landed_before(checkpoint, word) if before else None)


def _landed_before(checkpoint: str, word: str) -> str:
    return f"{checkpoint}/landed-before-{word}"


def _keep_landed(spark: SparkSession, root: str, now: Landings, owners: list[str], path: str) -> None:
    """The furthest position landed of every file that a dataset's rows come from. What
    was compacted has no owner any more, so all rows with a position count; files of
    other streams do no harm."""
    rows = read_stored(spark, root, now).where("position.file IS NOT NULL")
    (
        rows.groupBy(F.col("position.file").alias("file"))
        .agg(F.max("position.row").alias("last"))
        .write.mode("overwrite")
        .parquet(path)
    )


def not_landed_before(records: DataFrame, ledger: Ledger, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Records that no earlier checkpoint of the stream has landed. A file is always
    landed as a whole, a partition of a topic (without a time) up to an offset. The list
    has a row for each of them; up to ``limit_bytes`` of names it is broadcast."""
    if ledger.landed_before is None:
        return records
    spark = records.sparkSession
    landed = spark.read.schema("file STRING, last LONG").parquet(ledger.landed_before)
    size = landed.agg(F.coalesce(F.sum(F.octet_length("file") + 16), F.lit(0))).first()[0]
    landed = landed.select(F.col("file").alias("_file"), F.col("last").alias("_last"))
    known = F.col("position.at").isNotNull() | (F.col("position.row") <= F.col("_last"))
    return records.join(
        F.broadcast(landed) if size <= limit_bytes else landed,
        (F.col("position.file") == F.col("_file")) & known,
        "left_anti",
    )


def start_writer(
    envelopes: DataFrame,
    write: Writer,
    stream: str,
    checkpoint: str,
    once: bool = False,
    interval_ms: int = FLUSH_INTERVAL_MS,
) -> StreamingQuery:
    """Start a stream that hands every micro-batch and its number to ``write``. ``once``
    takes what is there in bounded batches and ends. The stream fails when a batch
    fails, and goes on from the checkpoint when started again."""
    writer = (
        envelopes.writeStream.queryName(stream)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms} milliseconds").start()


def start_file_sink(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    interval_ms: int = FLUSH_INTERVAL_MS,
) -> StreamingQuery:
    """Land a stream with Spark's own Parquet sink, which commits each batch in
    its log. The directory belongs to this one stream."""
    writer = (
        change_rows(envelopes)
        .writeStream.format("parquet")
        .partitionBy("cdc_table")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms} milliseconds").start()


def start_rejects(
    rejects: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Keep the records that are not landed, partitioned by reason, as a stream
    of its own beside the landing."""
    writer = (
        rejects.writeStream.format("parquet")
        .partitionBy("reason")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.start()
