"""One query per operator, over whole tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowharbor.functions import change_text as ct
from rowharbor.functions.lsn import lsn_number
from rowharbor.functions.types import type_label
from rowharbor.operators import catalog, changes, numbering, offsets, packing, settings, snapshot
from rowharbor.operators.lookup import stored
from rowharbor.plans.jobs import copy_slices, copy_table, copy_tables, follow_log, land_log
from rowharbor.work_dir import remove_dir, work_dir
from rowharbor.sources.spread import spread
from rowharbor.sinks.dataset import (
    REJECTED,
    compact_landings,
    migrate_schema_column,
    read_change_table,
    read_landed,
    read_migrating,
    read_rejected,
    read_stored,
)
from rowharbor.sinks.tables import insert_all
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]


def change_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.row_changes(inputs.text_log(spark, sf_dir)).select("event_id", "op")


def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = changes.located_changes(
        inputs.text_log(spark, sf_dir), inputs.event_lookup(spark)
    )
    return located.groupBy("table_name", "op").agg(F.count("*").alias("changes"))


def change_table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = inputs.table(spark, sf_dir, "events").select(
        "event_id", F.expr(inputs.ID_TEXT).alias("event_text")
    )
    text = F.col("event_text")
    return (
        ids.withColumn("oid", ct.table_oid(text))
        .withColumn("change_oid", ct.checked_table_oid(F.col("oid"), text))
        .select("event_id", ct.raw_table_id(text).alias("raw_id"), "oid", "change_oid")
    )


def table_lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.located_changes(
        inputs.text_log(spark, sf_dir), inputs.event_lookup(spark)
    ).select(
        "event_id",
        "oid",
        "table_name",
        F.coalesce(F.size("columns"), F.lit(0)).alias("n_columns"),
    )


def table_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.located_rows(
        inputs.order_rows_text(spark, sf_dir), inputs.event_lookup(spark)
    ).select(
        "o_orderkey",
        "raw_id",
        "oid",
        "table_name",
        F.coalesce(F.size("columns"), F.lit(0)).alias("n_columns"),
    )


def rejected_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.rejected_changes(
        inputs.text_log(spark, sf_dir), inputs.event_lookup(spark)
    ).select("event_id", "oid", "reason")


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.catalog_columns(
        *inputs.catalogs(spark, sf_dir), inputs.PUBLICATION
    )


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.order_catalog(_columns(spark, sf_dir))


def catalog_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = F.transform(
        "columns", lambda c: F.concat(c["name"], F.lit(" "), c["pg_type"])
    )
    return catalog.table_columns(_columns(spark, sf_dir)).select(
        "oid",
        "table_name",
        F.size("columns").alias("n_columns"),
        F.array_join(described, "|").alias("columns_text"),
    )


def mapped_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.mapped_tables(_columns(spark, sf_dir))


def type_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.part_types(spark, sf_dir).select(
        "p_partkey", "typname", type_label(F.col("typname")).alias("label")
    )


def schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = catalog.table_lookup(catalog.table_columns(_columns(spark, sf_dir)))
    fields = F.variant_get(
        "schema", "$.fields", "array<struct<field:string,type:string,optional:boolean>>"
    )
    return tables.select(
        "oid",
        F.variant_get("schema", "$.name", "string").alias("table_name"),
        F.variant_get("schema", "$.type", "string").alias("schema_type"),
        F.posexplode(fields).alias("position", "f"),
    ).select(
        "oid",
        "table_name",
        "schema_type",
        "position",
        F.col("f.field").alias("field"),
        F.col("f.type").alias("type"),
        F.col("f.optional").alias("optional"),
    )


def _cells(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per name in the payload: its text and the type it is stored as."""
    spark = rows.sparkSession
    payload = F.col("payload").outer()
    return rows.lateralJoin(spark.tvf.variant_explode(payload)).select(
        *keep,
        "key",
        F.col("value").cast("string").alias("value"),
        F.schema_of_variant("value").alias("stored_as"),
    )


def _text_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.text_envelopes(
        inputs.text_log(spark, sf_dir),
        inputs.event_lookup(spark),
        keep=["event_id", "pipeline_id", "lsn"],
    )


def payload_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(_text_envelopes(spark, sf_dir), "event_id")


def _scalars(envelopes: DataFrame) -> list:
    fields = F.variant_get("schema", "$.fields", "array<variant>")
    return [
        "cdc_table",
        "op",
        "ts_ms",
        F.variant_get("schema", "$.name", "string").alias("schema_name"),
        F.variant_get("schema", "$.type", "string").alias("schema_type"),
        F.coalesce(F.size(fields), F.lit(0)).alias("n_fields"),
    ]


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _text_envelopes(spark, sf_dir)
    first = F.coalesce(
        F.variant_get("payload", "$.event_id", "long"),
        F.variant_get("payload", "$.col_0", "long"),
    )
    return rows.select(
        "event_id", "pipeline_id", "lsn", *_scalars(rows), first.alias("payload_id")
    )


def typed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.typed_envelopes(
        inputs.typed_log(spark, sf_dir),
        inputs.event_lookup(spark),
        keep=["event_id", "pipeline_id", "lsn"],
    )
    cell = lambda name, i, kind: F.coalesce(
        F.variant_get("payload", f"$.{name}", kind),
        F.variant_get("payload", f"$.col_{i}", kind),
    )
    return rows.select(
        "event_id",
        *_scalars(rows),
        cell("user_id", 1, "long").alias("user_id"),
        cell("value", 2, "double").alias("value"),
        F.coalesce(
            F.variant_get("payload", "$.props.k", "long"),
            F.variant_get("payload", "$.col_3.k", "long"),
        ).alias("props_k"),
        cell("flag", 4, "boolean").alias("flag"),
    )


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(inputs.table(spark, sf_dir, "orders")).withColumn(
        "read_ts", F.col("o_orderdate").cast("timestamp")
    )
    rows = snapshot.typed_snapshot(
        orders, inputs.event_lookup(spark), inputs.ORDERS_OID, read_ts="read_ts"
    )
    return rows.select(
        *_scalars(rows),
        F.variant_get("payload", "$.o_orderkey", "long").alias("o_orderkey"),
        F.variant_get("payload", "$.o_custkey", "long").alias("o_custkey"),
        F.variant_get("payload", "$.o_orderstatus", "string").alias("o_orderstatus"),
        F.variant_get("payload", "$.o_totalprice", "double").alias("o_totalprice"),
        F.variant_get("payload", "$.o_orderpriority", "string").alias("o_orderpriority"),
        _time_text(F.variant_get("payload", "$.o_orderdate", "timestamp_ntz")).alias("ordered_at"),
    )


def _time_text(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def snapshot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of every kind in the copy of a typed table: an array, bytes, nulls, and how
    each is stored."""
    vectors = spread(inputs.table(spark, sf_dir, "embeddings")).select(
        "vec_id",
        "embedding",
        F.when(F.col("vec_id") % 3 != 0, F.col("label")).alias("label"),
        F.encode(F.concat(F.lit("v"), F.col("vec_id").cast("string")), "UTF-8").alias("raw"),
    )
    rows = snapshot.typed_snapshot(vectors, inputs.event_lookup(spark), inputs.VECTORS_OID)
    got = {
        "vec_id": F.variant_get("payload", "$.vec_id", "long"),
        "second": F.variant_get("payload", "$.embedding[1]", "double"),
        "n_components": F.size(F.variant_get("payload", "$.embedding", "array<variant>")),
        "label": F.variant_get("payload", "$.label", "int"),
        "has_label_key": F.array_contains(F.json_object_keys(F.to_json("payload")), "label"),
        "raw": F.decode(F.variant_get("payload", "$.raw", "binary"), "UTF-8"),
    }
    return rows.select("cdc_table", *[value.alias(name) for name, value in got.items()])


def snapshot_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot.text_snapshot(
        inputs.order_rows_text(spark, sf_dir),
        inputs.event_lookup(spark),
        keep=["o_orderkey"],
    )
    named = rows.withColumn(
        "schema_name", F.variant_get("schema", "$.name", "string")
    )
    return _cells(named, "o_orderkey", "cdc_table", "op", "ts_ms", "schema_name")


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot.text_snapshot(
        inputs.document_rows_text(spark, sf_dir),
        inputs.event_lookup(spark),
        keep=["doc_id"],
    )
    return _cells(rows, "doc_id", "cdc_table")


def batch_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = packing.packed_batches(_text_envelopes(spark, sf_dir), "event_id")
    flat = packing.flattened_batches(batches, keep=["cdc_table", "batch"])
    return flat.select(
        "cdc_table",
        "batch",
        "operation",
        F.variant_get("schema_database", "$.name", "string").alias("schema_name"),
        F.coalesce(
            F.variant_get("payload", "$.event_id", "long"),
            F.variant_get("payload", "$.col_0", "long"),
        ).alias("payload_id"),
    )


def batch_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches by a sequence that repeats: their rows, and whether each was in bounds."""
    batches = packing.bounded_batches(_text_envelopes(spark, sf_dir), "pipeline_id")
    size = F.size(F.from_json("batch_json", "array<struct<op:string>>"))
    measured = batches.withColumn("in_bounds", size <= packing.BATCH_ROWS)
    flat = packing.flattened_batches(
        measured, keep=["cdc_table", "in_bounds"]
    )
    return flat.select(
        "cdc_table",
        "in_bounds",
        "operation",
        F.coalesce(
            F.variant_get("payload", "$.event_id", "long"),
            F.variant_get("payload", "$.col_0", "long"),
        ).alias("payload_id"),
    )


def batch_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches bounded by rows and bytes: whether each was in bounds, and whether a
    table's batches are numbered without gaps."""
    batches = packing.measured_batches(
        _text_envelopes(spark, sf_dir), ["event_id"], batch_bytes=inputs.BATCH_BYTES
    )
    in_bounds = (F.col("n_rows") <= packing.BATCH_ROWS) & (F.col("n_bytes") <= inputs.BATCH_BYTES)
    counts = batches.groupBy("cdc_table").agg(
        (F.count("*") == F.max("batch") + 1).alias("right_count"),
        (F.count_distinct("batch") == F.count("*")).alias("all_different"),
    )
    numbered = (F.col("right_count") & F.col("all_different") & (F.col("batch") >= 0)).alias("is_numbered")
    checked = batches.join(counts, "cdc_table").select(
        "cdc_table", "batch_json", in_bounds.alias("in_bounds"), numbered
    )
    flat = packing.flattened_batches(checked, keep=["cdc_table", "in_bounds", "is_numbered"])
    return flat.select(
        "cdc_table", "in_bounds", "is_numbered", "operation", _payload_id("payload").alias("payload_id")
    )


def sliced_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The initial copy of the orders in slices by customer, a key that repeats; the job
    is done twice and copies each slice once."""
    root, lookup = work_dir(spark, "sliced"), inputs.event_lookup(spark)
    orders = inputs.table(spark, sf_dir, "orders")
    for _ in range(2):
        copy_slices(orders, lookup, inputs.ORDERS_OID, root, "first", "o_custkey", inputs.SLICES)
    landed = read_landed(spark, root)
    n_slices = landed.select(F.count_distinct("land_id").alias("n_slices"))
    return landed.select(
        "cdc_table", "operation", F.variant_get("payload", "$.o_orderkey", "long").alias("o_orderkey")
    ).join(F.broadcast(n_slices))


def migrated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset whose schema column is text, half of its landings copied to variants."""
    old, new = (work_dir(spark, f"migrated-{name}") for name in ("old", "new"))
    envelopes = _text_envelopes(spark, sf_dir)
    landing = F.concat(F.lit("batch-"), (F.col("event_id") % 4).cast("string"))
    envelopes.select(
        F.to_json("schema").alias("schema_database"),
        "payload",
        F.col("op").alias("operation"),
        landing.alias("land_id"),
        "cdc_table",
    ).write.partitionBy("land_id", "cdc_table").parquet(old)
    migrate_schema_column(spark, old, new, most=2)
    return read_migrating(spark, old, new).select(
        "cdc_table",
        "land_id",
        "operation",
        F.variant_get("schema_database", "$.name", "string").alias("schema_name"),
        _payload_id("payload").alias("payload_id"),
    )


def _counted(landed: DataFrame) -> DataFrame:
    return landed.groupBy("cdc_table", "operation").agg(F.count("*").alias("rows"))


def _land_orders(spark: SparkSession, sf_dir: str, root: str) -> None:
    orders = spread(inputs.table(spark, sf_dir, "orders"))
    lookup = inputs.event_lookup(spark)
    copy_table(orders, lookup, inputs.ORDERS_OID, root, "snapshot-orders")


def landed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "landed-counts")
    _land_orders(spark, sf_dir, root)
    log = inputs.text_log(spark, sf_dir)
    land_log(log, inputs.event_lookup(spark), root, "changes", compact=True)
    return _counted(read_landed(spark, root))


def landed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "landed-stream")
    _land_orders(spark, sf_dir, root)
    follow_log(
        inputs.streamed_text_log(spark, sf_dir),
        inputs.event_lookup(spark),
        root,
        "changes",
        work_dir(spark, "landed-stream-checkpoint"),
        once=True,
    ).awaitTermination()
    return read_landed(spark, root).select(
        "cdc_table",
        "operation",
        F.when(F.col("lsn").isNotNull(), F.col("ts_ms")).alias("ts_ms"),  # a copy has the time of reading
        "lsn",
        F.coalesce(_payload_id("payload"), F.variant_get("payload", "$.o_orderkey", "long")).alias("payload_id"),
    )


def landed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "landed-table")
    log = inputs.typed_log(spark, sf_dir)
    land_log(log, inputs.event_lookup(spark), root, "changes")
    return read_change_table(spark, root, "users").select(
        F.variant_get("payload", "$.event_id", "long").alias("event_id"),
        F.variant_get("payload", "$.value", "double").alias("value"),
        "operation",
        "ts_ms",
        "pipeline_id",
        "lsn",
    )


def scoped_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial copies from two databases that use one id for tables of two names."""
    orders = spread(inputs.table(spark, sf_dir, "orders"))
    lookup = inputs.scoped_lookup(spark)
    copies = [
        snapshot.typed_snapshot(
            orders, lookup, inputs.ORDERS_OID, scope={"pipeline_id": pipeline}
        )
        for pipeline, _ in inputs.SCOPED_TABLES
    ]
    return functools.reduce(DataFrame.unionByName, copies).select(
        "cdc_table",
        "pipeline_id",
        F.variant_get("schema", "$.name", "string").alias("schema_name"),
        F.variant_get("payload", "$.o_orderkey", "long").alias("o_orderkey"),
        _time_text(F.variant_get("payload", "$.o_orderdate", "timestamp_ntz")).alias("ordered_at"),
    )


def copied_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of all tables of a catalog after their initial copies."""
    root = work_dir(spark, "copied")
    read = functools.partial(inputs.table, spark, sf_dir)
    copy_tables(read, inputs.copied_lookup(spark), root, "first")
    payload = F.col("payload")
    # a table without columns is landed as text
    text = F.parse_json(F.variant_get(payload, "$.data", "string"))
    keys = [F.variant_get(payload, f"$.{k}", "long") for _, _, k in inputs.COPIED_TABLES if k]
    return read_landed(spark, root).select(
        "cdc_table",
        "operation",
        F.coalesce(*keys, F.variant_get(text, "$.s_suppkey", "long")).alias("key"),
    )


def landed_catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes in the catalog's change tables, each read back on its own."""
    database = f"landed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_dir(spark, database)}'")
    insert_all(_text_envelopes(spark, sf_dir), None, "changes", database)
    return _catalog_rows(spark, database)


def _payload_id(payload: str) -> Column:
    return F.coalesce(
        F.variant_get(payload, "$.event_id", "long"),
        F.variant_get(payload, "$.col_0", "long"),
    )


def _followed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A log of several files followed in as many batches: where the change tables with
    what was rejected and the positions are."""
    log, root, state = (work_dir(spark, f"followed-{name}") for name in ("log", "root", "state"))
    database = f"followed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_dir(spark, database)}'")
    inputs.log_in_files(spark, sf_dir, log)
    files = inputs.text_log_of_files(spark, log)
    _follow(spark, files, root, state, rejects=True, offsets=f"{database}.positions")
    return root, f"{database}.positions"


def _landed_rows(landed: DataFrame) -> DataFrame:
    return landed.select(
        "cdc_table",
        "operation",
        "ts_ms",
        "pipeline_id",
        "lsn",
        _payload_id("payload").alias("payload_id"),
    )


def followed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _followed(spark, sf_dir)
    return _landed_rows(read_landed(spark, root))


def followed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _followed(spark, sf_dir)
    return read_rejected(spark, root).select(
        F.variant_get("record", "$.event_id", "long").alias("event_id"),
        F.variant_get("record", "$.oid", "string").alias("oid"),
        "reason",
    )


def followed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, positions = _followed(spark, sf_dir)
    return offsets.current_offsets(spark, positions).select("pipeline_id", "last_lsn")


def _follow(spark: SparkSession, log: DataFrame, root: str, state: str, **options) -> None:
    lookup = stored(inputs.event_lookup(spark).df, work_dir(spark, "lookup"))
    follow_log(log, lookup, root, "changes", state, once=True, **options).awaitTermination()


def resumed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log followed half way, then without its checkpoint to the end: all rows, once."""
    log, root, state = (work_dir(spark, f"resumed-{name}") for name in ("log", "root", "state"))
    inputs.log_in_files(spark, sf_dir, log, files=[0, 1])
    _follow(spark, inputs.text_log_of_files(spark, log), root, state)
    remove_dir(spark, state)
    inputs.log_in_files(spark, sf_dir, log, files=[2])
    _follow(spark, inputs.text_log_of_files(spark, log), root, state)
    return _landed_rows(read_landed(spark, root))


def landed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every change table in the order of the log, over several files and
    batches; records of one transaction share their LSN."""
    log, root, state = (work_dir(spark, f"order-{name}") for name in ("log", "root", "state"))
    inputs.log_in_files(spark, sf_dir, log)
    shared = inputs.text_log_of_files(spark, log).withColumn("lsn", F.expr(inputs.SHARED_LSN))
    _follow(spark, shared, root, state)
    rows = read_landed(spark, root).select(
        "cdc_table", "lsn", "position", _payload_id("payload").alias("payload_id")
    ).withColumn("lsn_number", lsn_number(F.col("lsn")))
    ordered = numbering.consecutive(rows, ["cdc_table"], ["lsn_number", "position"])
    return ordered.select("cdc_table", "number", "lsn", "payload_id")


def landed_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What several batches landed, read after their landings were made one."""
    log, root, state = (work_dir(spark, f"compacted-{name}") for name in ("log", "root", "state"))
    inputs.log_in_files(spark, sf_dir, log)
    _follow(spark, inputs.text_log_of_files(spark, log), root, state)
    compact_landings(spark, root)
    return _landed_rows(read_landed(spark, root))


def bounded_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What batches larger than a flush land, and whether each piece held at most so many
    records, rejected ones included, and all but the last of a batch exactly so many."""
    log, root, state = (work_dir(spark, f"bounded-{name}") for name in ("log", "root", "state"))
    inputs.log_in_files(spark, sf_dir, log)
    files = inputs.text_log_of_files(spark, log)
    _follow(spark, files, root, state, rejects=True, most_rows=inputs.FLUSH_ROWS)
    stored = read_stored(spark, root)
    sizes = stored.groupBy("land_id", "piece").count()
    last = sizes.groupBy("land_id").agg(F.max("piece").alias("last"))
    exact = sizes.join(last, "land_id").select(
        "land_id",
        "piece",
        (
            (F.col("count") == inputs.FLUSH_ROWS)
            | ((F.col("piece") == F.col("last")) & (F.col("count") < inputs.FLUSH_ROWS))
        ).alias("in_bounds"),
    )
    landed = stored.where(F.col("cdc_table") != REJECTED).join(exact, ["land_id", "piece"])
    return landed.select("cdc_table", "in_bounds", "operation", _payload_id("payload").alias("payload_id"))


def followed_catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's change tables after a followed log and a compaction."""
    log, root, state = (work_dir(spark, f"tables-{name}") for name in ("log", "root", "state"))
    database = f"shown_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_dir(spark, database)}'")
    inputs.log_in_files(spark, sf_dir, log, files=[0, 1])
    _follow(spark, inputs.text_log_of_files(spark, log), root, state, tables=database)
    compact_landings(spark, root)
    inputs.log_in_files(spark, sf_dir, log, files=[2])
    _follow(spark, inputs.text_log_of_files(spark, log), root, state, tables=database)
    return _catalog_rows(spark, database)


def _catalog_rows(spark: SparkSession, database: str) -> DataFrame:
    tables = [r.tableName.upper() for r in spark.sql(f"SHOW TABLES IN {database}").collect()]
    rows = [
        spark.table(f"`{database}`.`{name}`").withColumn("cdc_table", F.lit(name))
        for name in tables
        if name.endswith("_CDC")
    ]
    return functools.reduce(DataFrame.unionByName, rows).select(
        "cdc_table",
        F.col("OPERATION").alias("operation"),
        F.col("CREATED_AT").isNotNull().alias("is_timed"),
        _payload_id("PAYLOAD").alias("payload_id"),
    )


def config_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settings.pipeline_settings(inputs.stored_settings(spark, sf_dir)).withColumn(
        "replication_id", F.col("replication_id").cast("string")
    )


def config_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settings.pipeline_actions(
        settings.pipeline_settings(inputs.running_settings(spark, sf_dir)),
        settings.pipeline_settings(inputs.desired_settings(spark, sf_dir)),
    )


def config_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions of three polls; some of the second are not taken, so the third says
    what to do about pipelines that run as the first version left them."""
    running = settings.RunningSet(spark, work_dir(spark, "running"))
    polls = []
    for n, version in enumerate(inputs.settings_versions(spark, sf_dir), 1):
        desired = settings.pipeline_settings(version)
        path = work_dir(spark, f"poll-{n}")
        running.poll(desired).write.parquet(path)
        actions = spark.read.parquet(path)
        running.took(desired, actions.where(f"NOT ({inputs.NOT_TAKEN})") if n == 2 else actions)
        polls.append(actions.select(F.lit(n).alias("poll"), "id", "action"))
    return functools.reduce(DataFrame.union, polls)


def config_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settings.stopped_ids(
        inputs.running_settings(spark, sf_dir), inputs.desired_settings(spark, sf_dir)
    )


def latest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.latest_positions(inputs.text_log(spark, sf_dir))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.merged_offsets(
        inputs.stored_offsets(spark, sf_dir),
        offsets.latest_positions(inputs.text_log(spark, sf_dir)),
        F.lit(inputs.UPDATED_AT).cast("timestamp_ntz"),
    )


def offset_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).withColumn(
        "updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")
    )


def offset_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.last_offset(_merged(spark, sf_dir), 7)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        change_counts,
        change_ops,
        change_table_ids,
        table_lookup_inner,
        table_lookup_left,
        rejected_changes,
        catalog_columns,
        catalog_schema,
        mapped_tables,
        type_labels,
        schema_fields,
        payload_cells,
        envelopes,
        typed_envelopes,
        snapshot_rows,
        snapshot_cells,
        snapshot_text_rows,
        snapshot_documents,
        batch_flatten,
        batch_bounds,
        landed_counts,
        landed_stream,
        landed_table,
        landed_catalog_tables,
        scoped_snapshot,
        copied_tables,
        followed_rows,
        followed_rejects,
        followed_positions,
        resumed_rows,
        landed_order,
        landed_compacted,
        bounded_landings,
        followed_catalog_tables,
        batch_bytes,
        sliced_copy,
        migrated_rows,
        config_scan,
        config_diff,
        config_polls,
        config_removed,
        latest_positions,
        offset_upsert,
        offset_lookup,
    )
}
