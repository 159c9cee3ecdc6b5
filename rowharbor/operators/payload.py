"""Payload objects of rows that hold their cells and their table's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.functions.cells import cell_names, payload_object


def with_payload(rows: DataFrame, without_cells: Column) -> DataFrame:
    """Adds ``payload`` to rows with ``cells``, ``names`` and ``ambiguous``; rows
    whose cells are null get ``without_cells``. Names and payload are separate
    projections, so cells are decoded once per row, not once per use."""
    keyed = rows.withColumn("keys", cell_names(F.col("cells"), F.col("names")))
    payload = payload_object(F.col("cells"), F.col("keys"), F.col("ambiguous"))
    return keyed.withColumn(
        "payload", F.when(F.col("cells").isNull(), without_cells).otherwise(payload)
    ).drop("keys")
