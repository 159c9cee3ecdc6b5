"""Consecutive numbers for rows of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowharbor.work_dir import work_dir

#: Ranges of groups are broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_ROWS = 500_000


def _ranged(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows sorted over all tasks, written once, with their range and their row in it."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_dir(spark, "ranges")
    (
        rows.repartitionByRange(ranges, *by, *order)
        .sortWithinPartitions(*by, *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def with_running(
    rows: DataFrame, by: Sequence[str], order: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Adds running sums over the rows of each group in ``order``, the row itself left out
    (``sums``: name to a non-negative whole number of a row). Rows are sorted by range, so
    that a group of any size is dealt to many tasks; what the ranges before hold is
    summed up in a table of a row for each group and range."""
    ranged = _ranged(rows.withColumns({f"_{n}": v for n, v in sums.items()}), by, order)
    inside = Window.partitionBy("_range", *by).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = totals.select(
        *by, "_range", *[F.coalesce(F.sum(f"_{n}").over(earlier), zero).alias(f"_start_{n}") for n in sums]
    )
    few = starts.count() <= BROADCAST_ROWS
    joined = ranged.join(F.broadcast(starts) if few else starts, [*by, "_range"])
    running = {n: F.col(f"_start_{n}") + F.coalesce(F.sum(f"_{n}").over(inside), zero) for n in sums}
    return joined.withColumns(running).select(*rows.columns, *sums)


def consecutive(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "number") -> DataFrame:
    """Rows with their number from 0 in their group, in ``order``; no number is left out.
    Rows that tie are numbered in any order."""
    return with_running(rows, by, order, {name: F.lit(1).cast("long")})
