"""Change records to envelopes.

Text records are ``(event_text, commit_ts, ...)``; typed records are
``(table_oid, kind, cells, commit_ts, ...)``. Columns named in ``keep`` (such as
``pipeline_id`` and ``lsn``) pass through. When the lookup is keyed by pipeline
as well, name that key in ``scope``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.functions import change_text as ct
from rowharbor.functions.cells import decode_cells
from rowharbor.functions.envelope import (
    change_schema_without_columns,
    change_table,
    epoch_millis,
    raw_payload,
)
from rowharbor.operators.lookup import BROADCAST_LIMIT_BYTES, Lookup, attach
from rowharbor.operators.payload import with_payload
from rowharbor.sinks.dataset import REJECTED

# A table of this name is never landed; operations of typed kinds.
UNKNOWN_TABLE = "unknown_table"
KIND_OPERATIONS = {"insert": "c", "update": "u", "delete": "d"}
CONTROL_KINDS = ("relation", "begin", "commit", "type")
# Our names for why a record is not landed.
CONTROL = "control"
NO_OPERATION = "no operation"
NO_TABLE = "no table"
BAD_CELLS = "bad cells"
BAD_RECORD = "bad record"


def row_changes(changes: DataFrame) -> DataFrame:
    """Text records that carry a row change, with ``op``; control records and
    records without a known operation are dropped."""
    text = F.col("event_text")
    return (
        changes.filter(~ct.is_control(text) & ct.has_operation(text))
        .withColumn("lowered", F.lower(text))
        .withColumn("op", ct.op_code(F.col("lowered")))
        .drop("lowered")
    )


def with_table_oid(changes: DataFrame) -> DataFrame:
    """Text records with ``oid``, the digits of their table's id."""
    text = F.col("event_text")
    return changes.withColumn("oid", ct.table_oid(text)).withColumn(
        "oid", ct.checked_table_oid(F.col("oid"), text)
    )


def located_changes(
    changes: DataFrame,
    lookup: Lookup,
    scope: Sequence[str] = (),
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    salt_by: Sequence[str] = ("event_text",),
) -> DataFrame:
    """Row changes with ``oid`` and their table's lookup columns; changes of
    tables that are not mapped are dropped."""
    known = lookup.keeping(lookup.df.filter(F.col("table_name") != UNKNOWN_TABLE))
    return attach(
        with_table_oid(row_changes(changes)),
        known,
        [*scope, "oid"],
        "inner",
        salt_by,
        limit_bytes,
    )


def _envelope(keep: Sequence[str]) -> list[Column]:
    schema = F.coalesce(
        F.col("schema"), change_schema_without_columns(F.col("table_name"))
    )
    return [
        change_table(F.col("table_name")).alias("cdc_table"),
        schema.alias("schema"),
        F.col("payload"),
        F.col("op"),
        epoch_millis(F.col("commit_ts")).alias("ts_ms"),
        *[F.col(c) for c in keep],
    ]


def text_envelopes(
    changes: DataFrame,
    lookup: Lookup,
    keep: Sequence[str] = (),
    scope: Sequence[str] = (),
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Envelopes of text change records."""
    text = F.col("event_text")
    salt_by = ["event_text", *keep]
    located = located_changes(changes, lookup, scope, limit_bytes, salt_by)
    decoded = located.withColumn(
        "tokens", ct.split_cells(ct.value_list(text))
    ).withColumn("cells", decode_cells(F.col("tokens")))
    return with_payload(decoded, raw_payload(text)).select(*_envelope(keep))


def kind_op(kind: Column) -> Column:
    """Operation of a typed record's kind, null for any other kind."""
    code = F.lit(None).cast("string")
    for word, op in KIND_OPERATIONS.items():
        code = F.when(F.lower(kind) == word, F.lit(op)).otherwise(code)
    return code


def typed_envelopes(
    changes: DataFrame,
    lookup: Lookup,
    keep: Sequence[str] = (),
    scope: Sequence[str] = (),
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Envelopes of typed change records: values keep their types and nulls, and
    the operation comes from ``kind`` alone. Records whose cells could not be
    read are not landed; ``rejected_typed_changes`` has them."""
    known = lookup.keeping(lookup.df.filter(F.col("table_name") != UNKNOWN_TABLE))
    kinds = list(KIND_OPERATIONS)
    located = attach(
        changes.filter(F.lower("kind").isin(kinds) & F.col("cells").isNotNull())
        .withColumn("op", kind_op(F.col("kind")))
        .withColumn("oid", F.col("table_oid").cast("string")),
        known,
        [*scope, "oid"],
        "inner",
        # the rows of one transaction differ in their cells only
        ["commit_ts", *keep, F.to_json("cells")],
        limit_bytes,
    )
    no_cells = F.parse_json(F.lit("{}"))
    return with_payload(located, no_cells).select(*_envelope(keep))


def _unreadable(changes: DataFrame) -> Column:
    """Whether a record of a JSON log could not be read; other logs have none."""
    if "bad_record" not in changes.columns:
        return F.lit(False)
    return F.col("bad_record").isNotNull()


def _rejected(
    changes: DataFrame,
    lookup: Lookup,
    early: Column,
    scope: Sequence[str],
    salt_by: Sequence[str],
    limit_bytes: int,
) -> DataFrame:
    """Records with an early reason, or without a mapped table for their oid."""
    known = lookup.keeping(
        lookup.df.filter(F.col("table_name") != UNKNOWN_TABLE)
        .select(*scope, "oid")
        .withColumn("mapped", F.lit(True))
    )
    checked = attach(
        changes.withColumn("early", early),
        known,
        [*scope, "oid"],
        "left",
        salt_by,
        limit_bytes,
    )
    reason = F.coalesce(
        F.col("early"), F.when(F.col("mapped").isNull(), F.lit(NO_TABLE))
    )
    return (
        checked.withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .drop("early", "mapped")
    )


def _simple(keep: Sequence[str]) -> list[str]:
    return [c for c in keep if c != "position"]


def _routed(checked: DataFrame, decoded, without_cells: Column, keep: Sequence[str], record: Sequence[str]) -> DataFrame:
    """Envelopes of the records without a reason; of the others the record itself, under
    the table ``rejected``. One reading gives both, and nothing of a rejected record is
    parsed."""
    landed = F.col("reason").isNull()
    rows = with_payload(decoded(checked), without_cells)
    table, schema, payload, op, *rest = _envelope(keep)
    record_of = F.to_variant_object(F.struct(*record, "oid"))
    return rows.select(
        F.when(landed, table).otherwise(F.lit(REJECTED)).alias("cdc_table"),
        F.when(landed, schema).alias("schema"),
        F.when(landed, payload).alias("payload"),
        F.when(landed, op).alias("op"),
        *rest,
        "reason",
        F.when(~landed, record_of).alias("record"),
    )


def _checked(
    located: DataFrame, lookup: Lookup, early: Column, scope: Sequence[str], salt_by: Sequence[str], limit_bytes: int
) -> DataFrame:
    """All records with their table's lookup columns and the reason, null if landed."""
    known = lookup.df.filter(F.col("table_name") != UNKNOWN_TABLE).withColumn("mapped", F.lit(True))
    # a record that is rejected early needs no table
    keyed = located.withColumn("early", early)
    found = attach(keyed, lookup.keeping(known), [*scope, "oid"], "left", salt_by, limit_bytes)
    no_table = F.when(F.col("mapped").isNull(), F.lit(NO_TABLE))
    return found.withColumn("reason", F.coalesce("early", no_table)).drop("early", "mapped")


def routed_text_changes(
    changes: DataFrame,
    lookup: Lookup,
    keep: Sequence[str] = (),
    scope: Sequence[str] = (),
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Envelopes of text records together with the records that are not landed, from one
    evaluation of every record: what ``text_envelopes`` and ``rejected_changes`` give."""
    text = F.col("event_text")
    located = with_table_oid(changes).withColumn("op", ct.op_code(F.lower(text)))
    checked = _checked(
        located, lookup, _early_text(changes), scope, ["event_text", *_simple(keep)], limit_bytes
    )

    def decoded(rows: DataFrame) -> DataFrame:
        parsed = F.when(F.col("reason").isNull(), text)
        return rows.withColumn("parsed", parsed).withColumn(
            "tokens", ct.split_cells(ct.value_list(F.col("parsed")))
        ).withColumn("cells", decode_cells(F.col("tokens")))

    return _routed(checked, decoded, raw_payload(F.col("parsed")), keep, changes.columns)


def routed_typed_changes(
    changes: DataFrame,
    lookup: Lookup,
    keep: Sequence[str] = (),
    scope: Sequence[str] = (),
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """As ``routed_text_changes``, of typed records."""
    located = changes.withColumn("op", kind_op(F.col("kind"))).withColumn("oid", F.col("table_oid").cast("string"))
    salt_by = ["commit_ts", *_simple(keep), F.to_json("cells")]
    checked = _checked(located, lookup, _early_typed(changes), scope, salt_by, limit_bytes)
    given = [F.to_json("cells").alias("cells") if c == "cells" else F.col(c) for c in changes.columns]
    return _routed(
        checked.withColumn("given", F.struct(*given)),
        lambda rows: rows,
        F.parse_json(F.lit("{}")),
        keep,
        [F.col("given")[c].alias(c) for c in changes.columns],
    )


def _early_text(changes: DataFrame) -> Column:
    text = F.col("event_text")
    return (
        F.when(_unreadable(changes), F.lit(BAD_RECORD))
        .when(ct.is_control(text), F.lit(CONTROL))
        .when(~ct.has_operation(text), F.lit(NO_OPERATION))
    )


def _early_typed(changes: DataFrame) -> Column:
    kind = F.lower("kind")
    return (
        F.when(_unreadable(changes), F.lit(BAD_RECORD))
        .when(kind.isin(*CONTROL_KINDS), F.lit(CONTROL))
        .when(kind_op(kind).isNull(), F.lit(NO_OPERATION))
        .when(F.col("cells").isNull(), F.lit(BAD_CELLS))
    )


def rejected_changes(
    changes: DataFrame,
    lookup: Lookup,
    scope: Sequence[str] = (),
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Text records that are not landed, each with the reason: JSON that could not be
    read, a control record, no known operation, or no mapped table."""
    early = _early_text(changes)
    return _rejected(
        with_table_oid(changes), lookup, early, scope, ["event_text"], limit_bytes
    )


def rejected_typed_changes(
    changes: DataFrame,
    lookup: Lookup,
    scope: Sequence[str] = (),
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Typed records that are not landed, each with the reason: as for text
    records, or cells that could not be read."""
    located = changes.withColumn("oid", F.col("table_oid").cast("string"))
    # the records of one transaction differ in their cells only
    salt_by = ["commit_ts", "lsn", F.to_json("cells")]
    return _rejected(located, lookup, _early_typed(changes), scope, salt_by, limit_bytes)
