"""Using all cores for an input, and bounded tasks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

FEW = 4
#: An input of more partitions is never moved, however many cores there are: at Spark's
#: default partition size these hold 1 GB.
MOST_MOVED = 8
#: Most records of a task that builds envelopes: what it sorts for its files is some 1 KB a
#: record, so 200 MB.
TASK_ROWS = 200_000


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a small input (of at most ``MOST_MOVED`` partitions) that would be
    read by less than a quarter of the cores, such as one file, over all cores.
    Larger inputs are left where they are, without a shuffle; so are streams. For
    inputs as they are read: counting the partitions of later steps could run them."""
    if rows.isStreaming:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    partitions = rows.rdd.getNumPartitions()
    if partitions > MOST_MOVED or partitions * FEW >= cores:
        return rows
    return rows.repartition(cores)


def task_counts(records: DataFrame) -> dict[int, int]:
    """How many records every task reads, by its number; one row a task reaches the driver.
    Of Parquet the files' footers say it. For records as they are read."""
    counts = records.groupBy(F.spark_partition_id().alias("task")).count()
    return {r["task"]: r["count"] for r in counts.collect()}


def dealt(records: DataFrame, counts: Mapping[int, int], together: Sequence[str] = ()) -> DataFrame:
    """Records in tasks of about ``TASK_ROWS`` at most, on all cores, when a task reads more
    than that or much more than its share. A file of one row group is read by one task,
    into however many slices it is cut, so the number of tasks says nothing; ``counts``
    does (``task_counts`` of the records as they are read). Records are moved by their
    number, or with those that are equal in ``together``: nothing is sorted to move them."""
    cores, total = records.sparkSession.sparkContext.defaultParallelism, sum(counts.values())
    most = max(counts.values(), default=0)
    if most <= TASK_ROWS and most * cores <= FEW * total:
        return records
    tasks = max(cores, -(-total // TASK_ROWS))
    if together:
        return records.repartition(tasks, *together)
    return records.withColumn("_number", F.monotonically_increasing_id()).repartition(tasks, "_number").drop("_number")
