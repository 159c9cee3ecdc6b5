"""Rows of an initial copy to envelopes; the operation is always ``c``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from rowharbor.functions import change_text as ct
from rowharbor.functions.cells import decode_cells
from rowharbor.functions.envelope import (
    SNAPSHOT_OP,
    change_table,
    data_payload,
    epoch_millis,
    schema_object,
    snapshot_schema_without_columns,
)
from rowharbor.operators.lookup import BROADCAST_LIMIT_BYTES, Lookup, attach
from rowharbor.operators.payload import with_payload


def located_rows(
    rows: DataFrame,
    lookup: Lookup,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Printed rows ``(table_id, row_text, ...)`` with the name and the columns
    of their table. The name is looked up by one reading of the id and the
    columns by another, as they can differ; an unmapped name is the id itself.
    ``scope`` are the other key columns of a lookup of several databases."""
    by_name = lookup.keeping(
        lookup.df.select(
            *scope, F.col("oid").alias("raw_id"), F.col("table_name").alias("known")
        )
    )
    by_oid = lookup.keeping(lookup.df.drop("table_name"))
    keyed = rows.withColumn("raw_id", ct.raw_table_id(F.col("table_id"))).withColumn(
        "oid", ct.table_oid(F.col("table_id"))
    )
    named = attach(keyed, by_name, [*scope, "raw_id"], "left", ["row_text"], limit_bytes)
    named = named.withColumn(
        "table_name", F.coalesce(F.col("known"), F.col("raw_id"))
    ).drop("known")
    return attach(named, by_oid, [*scope, "oid"], "left", ["row_text"], limit_bytes)


def text_snapshot(
    rows: DataFrame,
    lookup: Lookup,
    keep: Sequence[str] = (),
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Envelopes of printed snapshot rows ``(table_id, row_text, read_ts, ...)``."""
    text = F.col("row_text")
    known = F.col("columns").isNotNull()
    tokens = F.when(known, ct.split_cells(ct.row_list(text)))
    schema = (
        F.when(~known, snapshot_schema_without_columns())
        .when(F.col("raw_id") == F.col("oid"), F.col("schema"))
        .otherwise(schema_object(F.col("table_name"), F.col("columns")))
    )
    decoded = (
        located_rows(rows, lookup, limit_bytes, scope)
        .withColumn("tokens", tokens)
        .withColumn("cells", decode_cells(F.col("tokens")))
    )
    return with_payload(decoded, data_payload(text)).select(
        change_table(F.col("table_name")).alias("cdc_table"),
        schema.alias("schema"),
        "payload",
        F.lit(SNAPSHOT_OP).alias("op"),
        epoch_millis(F.col("read_ts")).alias("ts_ms"),
        *[F.col(c) for c in keep],
    )


def typed_snapshot(
    rows: DataFrame,
    lookup: Lookup,
    oid: str,
    read_ts: str | None = None,
    keep: Sequence[str] = (),
    scope: Mapping[str, int | str] | None = None,
) -> DataFrame:
    """Envelopes of one table's rows read with their types. The columns that are
    neither ``read_ts`` nor in ``keep`` are the table's. Of the lookup only this
    table's single row is read, at once. ``scope`` names the table's database in a
    lookup of several (``{"pipeline_id": 1}``) and is kept with the rows; more
    than one row for the table is an error."""
    scope = scope or {}
    cells = [c for c in rows.columns if c != read_ts and c not in keep]
    row = F.struct(*cells)
    own = F.col("oid") == oid
    for column, value in scope.items():
        own &= F.col(column) == value
    found = lookup.df.filter(own).select("table_name", F.to_json("schema").alias("schema")).head(2)
    if len(found) > 1:
        raise ValueError(f"the lookup has several tables {oid}; say which by scope")
    # one row, so its values stand in the plan: nothing is joined
    known = bool(found and found[0]["schema"] is not None)
    name = found[0]["table_name"] if found and found[0]["table_name"] is not None else oid
    schema = F.parse_json(F.lit(found[0]["schema"])) if known else snapshot_schema_without_columns()
    payload = F.to_variant_object(row) if known else data_payload(F.to_json(row))
    at = epoch_millis(F.col(read_ts) if read_ts else None)
    return rows.select(
        change_table(F.lit(name)).alias("cdc_table"),
        schema.alias("schema"),
        payload.alias("payload"),
        F.lit(SNAPSHOT_OP).alias("op"),
        at.alias("ts_ms"),
        *keep,
        *[F.lit(value).alias(column) for column, value in scope.items()],
    )
