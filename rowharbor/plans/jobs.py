"""Jobs a user starts: copy tables, land a log, say what pipelines to change."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rowharbor.operators.catalog import table_columns, table_lookup
from rowharbor.operators.changes import (
    rejected_changes,
    rejected_typed_changes,
    routed_text_changes,
    routed_typed_changes,
    text_envelopes,
    typed_envelopes,
)
from rowharbor.operators.lookup import Lookup, stored
from rowharbor.operators.offsets import latest_positions, raise_offsets
from rowharbor.operators.snapshot import typed_snapshot
from rowharbor.sinks.dataset import PIECE_COLUMN, in_pieces, land, landing_rows
from rowharbor.sinks.landings import landings
from rowharbor.sinks.tables import register_landings
from rowharbor.sinks.versions import Versions
from rowharbor.sources.change_log import numbered
from rowharbor.sources.spread import TASK_ROWS, dealt, task_counts
from rowharbor.streaming.landing import (
    FLUSH_INTERVAL_MS,
    landing_id,
    not_landed_before,
    open_ledger,
    start_rejects,
    start_writer,
)

POSITION = ("pipeline_id", "lsn", "position")
#: Whether Spark takes variants apart into columns of their own when it writes them.
SHREDDING = "spark.sql.variant.inferShreddingSchema"
TABLES_AT_ONCE = 4
#: Of the quantile sketch: a slice is off by one row in so many.
SLICE_ACCURACY = 100_000


def prepare_lookup(
    columns: DataFrame, path: str, keys: Sequence[str] = ("oid",)
) -> Lookup:
    """Work out the tables of a catalog once, at ``path``, and measure them. The
    later steps see this state; columns added afterwards are not known."""
    return stored(table_lookup(table_columns(columns, keys)), path)


def copy_table(
    rows: DataFrame,
    lookup: Lookup,
    oid: str,
    root: str,
    land_id: str,
    scope: Mapping[str, int | str] | None = None,
) -> None:
    """Land the initial copy of one table; ``scope`` as in ``typed_snapshot``."""
    land(typed_snapshot(rows, lookup, oid, scope=scope), root, land_id)


def copy_slices(
    rows: DataFrame,
    lookup: Lookup,
    oid: str,
    root: str,
    name: str,
    key: str,
    slices: int,
    scope: Mapping[str, int | str] | None = None,
) -> int:
    """Land the initial copy of one table in slices of near equal rows, each a landing of
    its own. Bounds of ``key`` (a number, date or timestamp) come from a quantile sketch
    that all tasks build together; they are kept beside the dataset, so that the job done
    again skips the slices that are landed, also if rows were added meanwhile or landings
    were compacted. Nulls are in the first slice; equal keys share one. A filter on the
    key is pushed down, into a database too. Returns the number of slices landed now."""
    spark = rows.sparkSession
    kept = Versions(spark, f"{root}/_copies/{name}-{oid}")
    kind = rows.schema[key].dataType.simpleString()
    if kept.newest() is None:
        shares = [F.lit(i / slices) for i in range(1, slices)]
        found = rows.agg(F.percentile_approx(key, F.array(*shares), SLICE_ACCURACY).cast("array<string>")).first()[0]
        kept.publish(0, sorted(set(found or ()), key=found.index) if found else [])
    bounds = [F.lit(b).cast(kind) for b in kept.newest()[1]]
    owner, at = f"copy/{name}-{oid}", F.col(key)
    done, landed = landings(spark, root).batches.get(owner, -1), 0
    for i, (low, high) in enumerate(zip([None, *bounds], [*bounds, None], strict=True)):
        if i <= done:
            continue
        below = F.lit(True) if high is None else at < high
        own = below if low is None else (at >= low) & below
        part = rows.where(own | at.isNull() if low is None else own)
        envelopes = typed_snapshot(part, lookup, oid, scope=scope)
        land(envelopes, root, f"{name}-{oid}-{i:06d}", owner=owner, batch=i)
        landed += 1
    return landed


def qualified(schema_name: str | None, table_name: str) -> str:
    """Name of a table in its database; bare if its schema is not known."""
    quoted = lambda word: '"' + word.replace('"', '""') + '"'
    return table_name if schema_name is None else f"{quoted(schema_name)}.{quoted(table_name)}"


def copy_tables(
    read: Callable[[str], DataFrame],
    lookup: Lookup,
    root: str,
    name: str,
    scope: Mapping[str, int | str] | None = None,
    at_once: int = TABLES_AT_ONCE,
    slices: Mapping[str, tuple[str, int]] | None = None,
) -> list[str]:
    """Land the initial copy of every table of a catalog; ``read`` gives a table's
    rows by its name, with its schema if the lookup has it. A table's landing is named
    after ``name`` and its id, so the job done again replaces its landings; tables in
    ``slices`` (id to key and number, as in ``copy_slices``) go on instead. ``at_once``
    tables are copied side by side; when some fail, the others are still copied and the
    first error is raised. Returns the ids. Only ids and names reach the driver."""
    tables = lookup.df
    for column, value in (scope or {}).items():
        tables = tables.filter(F.col(column) == value)
    schema_name = F.col("schema_name") if "schema_name" in tables.columns else F.lit(None).cast("string")
    found = tables.select("oid", "table_name", schema_name.alias("schema_name")).collect()
    named = sorted((r["oid"], qualified(r["schema_name"], r["table_name"])) for r in found)

    def copy(oid: str, table_name: str) -> str:
        if oid in (slices or {}):
            copy_slices(read(table_name), lookup, oid, root, name, *slices[oid], scope=scope)
        else:
            copy_table(read(table_name), lookup, oid, root, f"{name}-{oid}", scope)
        return oid

    with ThreadPoolExecutor(at_once) as pool:
        copies = [pool.submit(copy, *table) for table in named]
    return [done.result() for done in copies]


def land_log(
    log: DataFrame,
    lookup: Lookup,
    root: str,
    land_id: str,
    scope: Sequence[str] = (),
    compact: bool = False,
    rejects: bool = False,
    most_rows: int | None = None,
) -> None:
    """Land a text or typed change log in one batch; ``rejects`` and ``most_rows`` as in
    ``follow_log``."""
    records = log if most_rows is None else _in_tasks(log, most_rows)
    land(_rows(records, lookup, scope, rejects), root, land_id, compact)


def follow_log(
    log: DataFrame,
    lookup: Lookup,
    root: str,
    stream: str,
    checkpoints: str,
    scope: Sequence[str] = (),
    once: bool = False,
    compact: bool = False,
    interval_ms: int = FLUSH_INTERVAL_MS,
    rejects: bool = False,
    offsets: str | None = None,
    most_rows: int | None = None,
    tables: str | None = None,
) -> StreamingQuery:
    """Land a streaming change log. The envelopes are built per micro-batch, as a
    batch job: it is planned adaptively, and a batch of few files is spread. How a
    stream goes on after a crash or without its checkpoint is said in
    ``streaming.landing``.

    With ``rejects`` the records that are not landed are kept in the dataset too: one job
    reads every record once, decides, and writes both. With ``offsets`` (a directory) the
    positions of what was landed are recorded, from the columns of the landing. With
    ``most_rows`` a micro-batch is written in pieces of at most so many records. With
    ``tables`` (a database) the change tables are kept in the catalog too.

    A micro-batch's variants are written whole: taking them apart costs more than building
    them. ``compact_landings`` takes them apart, as the session says, for who reads often."""
    spark, checkpoint = log.sparkSession, f"{checkpoints}/{stream}"
    ledger = open_ledger(spark, stream, checkpoint, root, "position" in log.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set(SHREDDING, "false")  # a session of the stream's own
        land_id = landing_id(ledger.owner.replace("/", "-"), batch_id)
        if landings(spark, root).batches.get(ledger.owner, -1) < batch_id:
            records = not_landed_before(_in_tasks(numbered(batch), most_rows), ledger)
            land(_rows(records, lookup, scope, rejects), root, land_id, compact, ledger.owner, batch_id)
        if offsets is not None:
            record_positions(spark, landing_rows(spark, root, land_id), offsets)
        if tables is not None:
            register_landings(spark, root, tables)

    return start_writer(log, write, stream, checkpoint, once, interval_ms)


def follow_rejects(
    log: DataFrame,
    lookup: Lookup,
    path: str,
    checkpoint: str,
    scope: Sequence[str] = (),
    once: bool = False,
) -> StreamingQuery:
    """Keep the records of a log that are not landed, as a stream of its own, which
    reads the log once more; ``follow_log`` can do it from its own reading."""
    return start_rejects(_rejects(log, lookup, scope), path, checkpoint, once)


def record_positions(spark: SparkSession, landed: DataFrame, offsets: str) -> None:
    """Put the highest landed LSN of every pipeline in the offsets table. A position
    never goes back: files of a log may arrive in another order than its records."""
    raise_offsets(spark, offsets, latest_positions(landed))


def _rejects(log: DataFrame, lookup: Lookup, scope: Sequence[str]) -> DataFrame:
    if "cells" not in log.columns:
        return rejected_changes(log, lookup, scope)
    # Variants are kept as text, so that the bad records are easy to look at.
    rejects = rejected_typed_changes(log, lookup, scope)
    return rejects.withColumn("cells", F.to_json("cells"))


def _in_tasks(records: DataFrame, most_rows: int | None) -> DataFrame:
    """Records as they are read, in pieces if so wished, dealt to tasks of bounded size."""
    counts = task_counts(records)
    if most_rows is None:
        return dealt(records, counts)
    together = [PIECE_COLUMN] if most_rows <= TASK_ROWS else []
    return dealt(in_pieces(records, most_rows, counts), counts, together)


def _rows(log: DataFrame, lookup: Lookup, scope: Sequence[str], rejects: bool) -> DataFrame:
    typed = "cells" in log.columns
    if rejects:
        build = routed_typed_changes if typed else routed_text_changes
    else:
        build = typed_envelopes if typed else text_envelopes
    keep = [c for c in (*POSITION, PIECE_COLUMN) if c in log.columns]
    return build(log, lookup, keep=keep, scope=scope)
