"""Batches of envelopes as JSON arrays, and back to rows.

Landing does not need this: it is for consumers that take a batch as one text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.operators.numbering import consecutive, with_running

BATCH_ROWS = 500
BATCH_BYTES = 1 << 20


def _envelope() -> Column:
    return F.to_json(F.struct("schema", "payload", "op", "ts_ms"))


def _batch_json(rows: Column) -> Column:
    """The array of the rows' texts, in the order of the rows."""
    texts = F.transform(F.array_sort(rows), lambda r: r["text"])
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def packed_batches(
    envelopes: DataFrame, sequence: str, batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """One JSON array of envelopes per table and batch, in ``sequence`` order.

    ``sequence`` is a whole number unique among a table's rows (a number from the
    LSN, say), so a batch has at most ``batch_rows`` rows however many the table
    has, and a large table's batches are spread over all tasks.
    """
    batch = F.expr(f"`{sequence}` div {int(batch_rows)}")
    return (
        envelopes.select(
            "cdc_table",
            batch.alias("batch"),
            F.struct(F.col(sequence).alias("at"), _envelope().alias("text")).alias("row"),
        )
        .groupBy("cdc_table", "batch")
        .agg(_batch_json(F.collect_list("row")).alias("batch_json"))
    )


def bounded_batches(
    envelopes: DataFrame, sequence: str, batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """One JSON array of envelopes per table and batch, for any ``sequence``: it may
    repeat (the LSN of a bulk transaction) or have gaps.

    Rows are dealt in ranges of table, sequence and envelope, so that the rows of one
    sequence value are split too, and numbered within their range; a batch is
    ``batch_rows`` of them, or less at the end of a range or table. Batch numbers rise
    with the sequence but are not consecutive, and depend on how the rows were dealt.
    """
    order = ["cdc_table", "at", "tie"]
    dealt = (
        envelopes.select(
            "cdc_table", F.col(sequence).alias("at"), _envelope().alias("text")
        )
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    # the id holds the range above bit 33 and the row's place in it below
    return (
        dealt.withColumn("id", F.monotonically_increasing_id())
        .withColumn("place", F.expr("id & ((1L << 33) - 1)"))
        .groupBy("cdc_table", F.expr(f"id - place + place div {int(batch_rows)}").alias("batch"))
        .agg(_batch_json(F.collect_list(F.struct("at", "tie", "text"))).alias("batch_json"))
    )


def measured_batches(
    envelopes: DataFrame, order: Sequence[str], batch_rows: int = BATCH_ROWS, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """One JSON array of envelopes per table and batch, in ``order``, of at most
    ``batch_rows`` rows and ``batch_bytes`` bytes of text; batches are numbered from 0
    in every table, without gaps. An envelope longer than that has a batch of its own.

    Cuts come from running sums over rows sorted by range, so no task holds a table: after
    every ``batch_rows`` rows, after every half of the bytes, and on either side of rows
    longer than that half. What lies between two cuts is within both bounds.
    """
    half = (int(batch_bytes) - 2) // 2  # two brackets; a comma goes with each text
    size = F.octet_length("text") + 1
    texts = envelopes.select("cdc_table", *order, _envelope().alias("text")).withColumn("tie", F.xxhash64("text"))
    sized = texts.withColumn("size", size.cast("long")).withColumn("long", F.col("size") > half)
    sums = {
        "rows_before": F.lit(1).cast("long"),
        "bytes_before": F.when(F.col("long"), 0).otherwise(F.col("size")).cast("long"),
        "long_before": F.col("long").cast("long"),
    }
    running = with_running(sized, ["cdc_table"], [*order, "tie"], sums)
    cut = [
        (F.col("long_before") * 2 + F.col("long").cast("long")).alias("by_long"),
        F.expr(f"bytes_before div {half}").alias("by_bytes"),
        F.expr(f"rows_before div {int(batch_rows)}").alias("by_rows"),
    ]
    keys = ["cdc_table", "by_long", "by_bytes", "by_rows"]
    rows = running.select("*", *cut)
    first = rows.groupBy(*keys).agg(F.min("rows_before").alias("first")).drop("by_long", "by_bytes", "by_rows")
    numbers = consecutive(first, ["cdc_table"], ["first"], "batch")
    listed = F.collect_list(F.struct(F.col("rows_before").alias("at"), "tie", "text"))
    batches = rows.groupBy(*keys).agg(
        F.min("rows_before").alias("first"), F.count("*").alias("n_rows"), _batch_json(listed).alias("batch_json")
    )
    return batches.join(numbers, ["cdc_table", "first"]).select(
        "cdc_table", "batch", "n_rows", F.octet_length("batch_json").alias("n_bytes"), "batch_json"
    )


def flattened_batches(
    batches: DataFrame, keep: Sequence[str] = ("cdc_table",)
) -> DataFrame:
    """One row per envelope of the arrays in ``batch_json``: schema, payload and
    operation; the envelope's time is not among the change table's columns."""
    spark = batches.sparkSession
    value = F.col("value")
    exploded = batches.select(
        *keep, F.parse_json("batch_json").alias("batch_value")
    ).lateralJoin(spark.tvf.variant_explode(F.col("batch_value").outer()))
    return exploded.select(
        *keep,
        F.variant_get(value, "$.schema", "variant").alias("schema_database"),
        F.variant_get(value, "$.payload", "variant").alias("payload"),
        F.variant_get(value, "$.op", "string").alias("operation"),
    )
