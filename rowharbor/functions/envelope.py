"""The envelope around every row: schema, payload, operation, time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowharbor.functions.types import type_label

# Names inside the envelope and of the change tables.
STRUCT_TYPE = "struct"
TABLE_SUFFIX = "_CDC"
SNAPSHOT_OP = "c"


def change_table(table_name: Column) -> Column:
    """Change table a source table lands in."""
    return F.concat(F.upper(table_name), F.lit(TABLE_SUFFIX))


def schema_object(table_name: Column, columns: Column) -> Column:
    """Schema of a table with known columns (array of name, pg_type)."""
    fields = F.transform(
        columns,
        lambda c: F.struct(
            c["name"].alias("field"),
            type_label(c["pg_type"]).alias("type"),
            F.lit(True).alias("optional"),
        ),
    )
    return F.to_variant_object(
        F.struct(
            F.lit(STRUCT_TYPE).alias("type"),
            fields.alias("fields"),
            table_name.alias("name"),
        )
    )


def change_schema_without_columns(table_name: Column) -> Column:
    return F.to_variant_object(F.struct(table_name.alias("name")))


def snapshot_schema_without_columns() -> Column:
    return F.parse_json(F.lit("{}"))


def raw_payload(text: Column) -> Column:
    """Payload of a change record whose value list was not found."""
    return F.to_variant_object(F.struct(text.alias("raw")))


def data_payload(text: Column) -> Column:
    """Payload of a snapshot row whose columns are not known."""
    return F.to_variant_object(F.struct(text.alias("data")))


def epoch_millis(at: Column | None = None) -> Column:
    """Milliseconds of ``at``, or of now."""
    return F.unix_millis(F.current_timestamp() if at is None else at.cast("timestamp"))
