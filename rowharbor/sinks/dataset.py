"""All change tables as one Parquet dataset.

Layout: ``<root>/land_id=<landing>/part=<part>/piece=<n>/cdc_table=<TABLE>_CDC/*.parquet``. A
landing is one snapshot or one micro-batch. Each time it is written it gets a part of its
own, which counts once it is committed (``landings.py``); so doing it again after a
failure replaces its own output and nothing else, and a reader sees all of it or nothing. One job
writes every table of a landing; no shuffle is needed, since tasks write each
table they meet. A landing bounded by rows has as many pieces as it takes, else one; a file
holds many pieces, one after the other, and the column ``in_piece`` says which a row is of, so
a piece has no files of its own to open. (The directory is ``piece=0`` then; landings
written before have one for each piece, and are read as well.) Records that are not landed
can be kept beside, as the table ``rejected``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rowharbor.sinks.landings import Landings, commit, landings
from rowharbor.sinks.versions import Versions
from rowharbor.sources.spread import TASK_ROWS, task_counts
from rowharbor.work_dir import bytes_below, files_below, remove_dir

TABLE_COLUMN = "cdc_table"
LANDING_COLUMN = "land_id"
PART_COLUMN = "part"
PIECE_COLUMN = "piece"
#: The piece of a row, where the landing has several.
IN_PIECE = "in_piece"
MAX_RECORDS_PER_FILE = 5_000_000
#: Most bytes of files that a task of a compaction reads, for rows that are wide.
TASK_BYTES = 64 << 20
#: Where rejected records are; no change table has a name without the suffix.
REJECTED = "rejected"
#: Where a record stands in its log; see ``sources.change_log``.
POSITION = "STRUCT<at: TIMESTAMP, file: STRING, block: LONG, row: LONG>"
LANDED = (
    "schema_database VARIANT, payload VARIANT, operation STRING, "
    "created_at TIMESTAMP_NTZ, ts_ms LONG, pipeline_id INT, lsn STRING, "
    f"position {POSITION}, {LANDING_COLUMN} STRING, {TABLE_COLUMN} STRING"
)
_STORED = f"{LANDED}, reason STRING, record VARIANT, {PART_COLUMN} STRING, {PIECE_COLUMN} LONG"
_IN_FILES = f"{_STORED}, {IN_PIECE} LONG"
_OURS = ("reason", "record", PART_COLUMN, PIECE_COLUMN)
#: Hours after which parts that do not count may go; no reader is that old.
KEEP_HOURS = 24


def change_rows(envelopes: DataFrame) -> DataFrame:
    """Envelopes as rows of a change table: the envelope's schema, payload and
    operation under the table's column names, and the time of writing. Time,
    pipeline and position of the change are kept when they are there, and so are a
    rejected record and the reason."""
    extra = ("ts_ms", "pipeline_id", "lsn", "position", "reason", "record", PIECE_COLUMN)
    return envelopes.select(
        TABLE_COLUMN,
        F.col("schema").alias("schema_database"),
        "payload",
        F.col("op").alias("operation"),
        F.localtimestamp().alias("created_at"),
        *[c for c in extra if c in envelopes.columns],
    )


def in_pieces(records: DataFrame, most_rows: int, counts: Mapping[int, int] | None = None) -> DataFrame:
    """Records with the piece they belong to, of ``most_rows`` records each and the last
    of what is left, in the order they are read. ``counts`` are their ``task_counts``, if
    they are known already. For records as they are read."""
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    starts, total = [], 0
    for task, n in sorted((task_counts(records) if counts is None else counts).items()):
        starts.append((task, total))
        total += n
    table = records.sparkSession.createDataFrame(starts, "_task INT, _start LONG")
    numbered = records.withColumn("_task", F.spark_partition_id()).withColumn("_inside", inside)
    piece = F.floor((F.col("_start") + F.col("_inside")) / F.lit(most_rows)).alias(PIECE_COLUMN)
    return numbered.join(F.broadcast(table), "_task").select(*records.columns, piece)


def _write(rows: DataFrame, root: str, land_id: str, part: str) -> None:
    in_pieces = PIECE_COLUMN in rows.columns
    if in_pieces:
        rows = rows.withColumnRenamed(PIECE_COLUMN, IN_PIECE)
    rows = rows.withColumn(PIECE_COLUMN, F.lit(0).cast("long"))
    if in_pieces:  # statistics of the files then say where a piece is
        rows = rows.sortWithinPartitions(PIECE_COLUMN, TABLE_COLUMN, IN_PIECE)
    (
        rows.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(PIECE_COLUMN, TABLE_COLUMN)
        .parquet(f"{root}/{LANDING_COLUMN}={land_id}/{PART_COLUMN}={part}")
    )


def land(
    envelopes: DataFrame,
    root: str,
    land_id: str,
    compact: bool = False,
    owner: str = "",
    batch: int | None = None,
) -> str:
    """Write a landing and let it count; returns its part. An empty one has no rows.
    A landing done again by the same ``owner`` (a stream, else none) replaces itself.

    Without ``compact`` the rows are written where they are; with many tables in
    many tasks that gives many small files. ``compact`` adds one shuffle by table
    in which Spark merges small partitions and splits large ones, so a table that
    holds most rows is still written by many tasks.
    """
    rows = change_rows(envelopes)
    if compact and PIECE_COLUMN not in rows.columns:  # a piece is in few tasks already
        rows = rows.hint("rebalance", F.col(TABLE_COLUMN))
    part = uuid.uuid4().hex[:12]
    _write(rows, root, land_id, part)
    commit(envelopes.sparkSession, root, {land_id: part}, owner, batch=batch)
    return part


def read_stored(spark: SparkSession, root: str, at: Landings | None = None) -> DataFrame:
    """Everything that counts, rejected records too, as of one version."""
    at = at or landings(spark, root)
    directories = [f"{root}/{at.directory(i)}" for i in sorted(at.parts)]
    if not directories:
        return spark.createDataFrame([], _STORED)
    found = spark.read.schema(_IN_FILES).option("basePath", root).parquet(*directories)
    piece = F.coalesce(IN_PIECE, PIECE_COLUMN).alias(PIECE_COLUMN)
    return found.select(*[piece if c == PIECE_COLUMN else c for c in found.columns if c != IN_PIECE])


def read_landed(spark: SparkSession, root: str, at: Landings | None = None) -> DataFrame:
    """Rows of all change tables; a filter on ``cdc_table`` prunes directories. What is
    landed later, or compacted, does not show: the version is that of the call."""
    stored = read_stored(spark, root, at)
    return stored.filter(F.col(TABLE_COLUMN) != REJECTED).drop(*_OURS)


def landing_rows(spark: SparkSession, root: str, land_id: str) -> DataFrame:
    """Rows of one landing; none if it was compacted meanwhile."""
    now = landings(spark, root)
    if land_id not in now.parts:
        return read_landed(spark, root, Landings())
    return read_landed(spark, root, Landings(now.version, {land_id: now.parts[land_id]}))


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Records that were not landed, as variants, each with the reason."""
    stored = read_stored(spark, root).filter(F.col(TABLE_COLUMN) == REJECTED)
    return stored.select("reason", "record", "position", LANDING_COLUMN)


def read_change_table(spark: SparkSession, root: str, table_name: str) -> DataFrame:
    """Rows of one source table's change table; none if nothing of it was landed. For
    a plain name only the table's own directory is listed in every landing; a name
    that directories spell otherwise is filtered, as in ``read_landed``."""
    own = F.col(TABLE_COLUMN) == F.concat(F.upper(F.lit(table_name)), F.lit("_CDC"))
    if re.fullmatch("[A-Za-z0-9_]+", table_name):
        now = landings(spark, root)
        directory = f"{TABLE_COLUMN}={table_name.upper()}_CDC"
        path = f"{root}/{LANDING_COLUMN}=*/{PART_COLUMN}=*/{PIECE_COLUMN}=*/{directory}"
        try:
            found = spark.read.schema(_STORED).option("basePath", root).parquet(path)
            counts = F.col(PART_COLUMN).isin(list(now.parts.values()))
            return found.filter(own & counts).drop(*_OURS)
        except AnalysisException:  # no landing has the table
            pass
    return read_landed(spark, root).filter(own)


def in_log_order(rows: DataFrame) -> DataFrame:
    """Landed rows in the order of their log: of its files by time and name, in a file
    by row. Records of one transaction share position and time of commit, so this order
    is what tells them apart. Sorted by range, not by one task."""
    return rows.orderBy("position")


def compact_landings(
    spark: SparkSession, root: str, land_ids: Iterable[str] | None = None, name: str | None = None
) -> str | None:
    """Write the given landings (all that count, if none are given) as one, with files of
    full size in which a table's rows are in log order. Tasks have ranges of that order, of
    some ``TASK_ROWS`` rows, so a table of any size is dealt to many of them, and its files
    follow each other. Readers keep what they opened, new ones see the compacted landing;
    nothing is doubled in between, and a crash before the change leaves all as it was.
    Landings that another compaction has taken meanwhile fail this one. Returns the new
    landing's id, None if there is nothing to do."""
    now = landings(spark, root)
    gone = sorted(now.parts if land_ids is None else land_ids)
    if len(gone) < 2:
        return None
    few = Landings(now.version, {i: now.parts[i] for i in gone})
    rows = read_stored(spark, root, few).drop(LANDING_COLUMN, PART_COLUMN, PIECE_COLUMN)
    size = sum(bytes_below(spark, f"{root}/{few.directory(i)}") for i in gone)
    tasks = max(1, -(-rows.count() // TASK_ROWS), -(-size // TASK_BYTES))
    order = (TABLE_COLUMN, "position", "_number")  # the number parts rows that have no position
    rows = rows.withColumn("_number", F.monotonically_increasing_id()).repartitionByRange(tasks, *order)
    rows = rows.drop("_number").sortWithinPartitions(TABLE_COLUMN, "position")
    land_id, part = name or f"compacted-{uuid.uuid4().hex[:12]}", uuid.uuid4().hex[:12]
    _write(rows, root, land_id, part)
    commit(spark, root, {land_id: part}, gone=gone)
    return land_id


def remove_unused(spark: SparkSession, root: str, keep_hours: float = KEEP_HOURS) -> list[str]:
    """Delete parts that do not count and are older than ``keep_hours``: those replaced,
    compacted or left by a crash. Returns what was deleted."""
    # listed before the version is read: what is committed in between counts
    found = files_below(spark, f"{root}/{LANDING_COLUMN}=*/{PART_COLUMN}=*")
    now = landings(spark, root)
    counted = {now.directory(i) for i in now.parts}
    removed = [
        path for path, hours in found if hours >= keep_hours and "/".join(path.split("/")[-2:]) not in counted
    ]
    for path in removed:
        remove_dir(spark, path)
    return removed


def with_variant_schema(old: DataFrame) -> DataFrame:
    """Rows of a change table whose schema column is still text, with it as a
    variant. Text that is not JSON stays, as a JSON string."""
    text = F.col("schema_database")
    return old.withColumn(
        "schema_database",
        F.coalesce(F.try_parse_json(text), text.cast("variant")),
    )


def _text_landings(spark: SparkSession, old_root: str) -> list[str]:
    found = files_below(spark, f"{old_root}/{LANDING_COLUMN}=*")
    return sorted(path.rsplit(f"{LANDING_COLUMN}=", 1)[1] for path, _ in found)


def _text_landing(spark: SparkSession, old_root: str, land_id: str) -> DataFrame:
    """Rows of a landing whose schema column is text, as they are landed now."""
    old = with_variant_schema(spark.read.parquet(f"{old_root}/{LANDING_COLUMN}={land_id}"))
    fields = StructType.fromDDL(_STORED).fields
    have = [F.col(f.name) if f.name in old.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return old.select(*have).withColumn(LANDING_COLUMN, F.lit(land_id)).withColumn(PIECE_COLUMN, F.lit(0).cast("long"))


def _migrated(spark: SparkSession, new_root: str) -> set[str]:
    """Landings that were copied, also those compacted since."""
    noted = Versions(spark, f"{new_root}/_migrated")
    return {noted.read(n) for n in noted.numbers()} | set(landings(spark, new_root).parts)


def migrate_schema_column(spark: SparkSession, old_root: str, new_root: str, most: int | None = None) -> list[str]:
    """Copy the landings of a dataset with a text schema column
    (``land_id=<landing>/cdc_table=<table>``) to ``new_root`` with a variant one, landing by
    landing: what was copied before is skipped, so the job can stop (after ``most``
    landings) and go on. The old data stays as it is, and ``read_migrating`` shows all rows
    meanwhile. One such job at a time. Returns the landings copied now."""
    noted, copied = Versions(spark, f"{new_root}/_migrated"), []
    done = _migrated(spark, new_root)
    for land_id in [i for i in _text_landings(spark, old_root) if i not in done][:most]:
        part = uuid.uuid4().hex[:12]
        rows = _text_landing(spark, old_root, land_id).drop(LANDING_COLUMN, PART_COLUMN, PIECE_COLUMN)
        _write(rows, new_root, land_id, part)
        commit(spark, new_root, {land_id: part}, f"migration/{old_root}")
        noted.publish(len(noted.numbers()), land_id)
        copied.append(land_id)
    return copied


def read_migrating(spark: SparkSession, old_root: str, new_root: str) -> DataFrame:
    """Rows of both datasets while one is copied to the other, each landing once."""
    done = _migrated(spark, new_root)
    rows = read_landed(spark, new_root)
    for land_id in [i for i in _text_landings(spark, old_root) if i not in done]:
        rows = rows.unionByName(_text_landing(spark, old_root, land_id).select(*rows.columns))
    return rows
