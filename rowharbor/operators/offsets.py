"""Last log position of every pipeline.

The table holds one row per pipeline, so it stays small. Parquet tables take no
MERGE: a new version is written beside the old one, as a partition, and read once it is
published; of writers at the same time one is first and the others merge again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowharbor.functions.lsn import lsn_digits, lsn_number, lsn_small_letters, lsn_text
from rowharbor.sinks.versions import Versions

#: More than the small letters of an LSN can count, and than they and its digits can.
CASES = 1 << 17
SHAPES = CASES * 16 * 32


def create_offsets_table(spark: SparkSession, table: str) -> None:
    """Create the offsets table, versions as partitions, unless it is there."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {table} (
            pipeline_id INT NOT NULL,
            last_lsn STRING,
            updated_at TIMESTAMP_NTZ DEFAULT localtimestamp(),
            version BIGINT
        ) USING parquet PARTITIONED BY (version)"""
    )


def latest_positions(changes: DataFrame) -> DataFrame:
    """Highest LSN of every pipeline in a batch of changes, as it was given.

    The maximum is of one number that holds the LSN's number, then its digits before and
    after the slash, then the case of its letters: numbers are reduced by hash before the
    one shuffle, where a maximum that carries text would sort all rows. Of equal LSNs the
    one with most digits counts.
    """
    lsn = F.col("lsn")
    high_digits, low_digits = lsn_digits(lsn)
    shape = (high_digits * 16 + low_digits).cast("long") * CASES + lsn_small_letters(lsn)
    packed = (lsn_number(lsn) * F.lit(SHAPES) + shape).cast("decimal(38,0)")
    tops = changes.select("pipeline_id", packed.alias("packed")).groupBy("pipeline_id").agg(
        F.max("packed").alias("packed")
    )
    rest = (F.col("packed") % F.lit(SHAPES)).cast("long")
    unpacked = tops.select(
        "pipeline_id",
        # exact: what is divided is a multiple
        ((F.col("packed") - rest) / F.lit(SHAPES)).cast("decimal(20,0)").alias("number"),
        F.floor(rest / (16 * CASES)).cast("int").alias("high_digits"),
        (F.floor(rest / CASES) % 16).cast("int").alias("low_digits"),
        (rest % CASES).alias("small"),
    )
    text = lsn_text(F.col("number"), F.col("high_digits"), F.col("low_digits"), F.col("small"))
    return unpacked.select("pipeline_id", text.alias("last_lsn"))


def merged_offsets(
    target: DataFrame, source: DataFrame, updated_at: Column | None = None
) -> DataFrame:
    """``target`` after an upsert of ``source`` (pipeline_id, last_lsn): a match
    takes the source's LSN and a new time, other rows of either side stay."""
    now = F.localtimestamp() if updated_at is None else updated_at
    old = target.select(
        "pipeline_id",
        F.col("last_lsn").alias("old_lsn"),
        F.col("updated_at").alias("old_at"),
    )
    new = source.select(
        "pipeline_id", F.col("last_lsn").alias("new_lsn"), F.lit(True).alias("given")
    )
    given = F.col("given").isNotNull()
    return old.join(new, "pipeline_id", "full_outer").select(
        "pipeline_id",
        F.when(given, F.col("new_lsn")).otherwise(F.col("old_lsn")).alias("last_lsn"),
        F.when(given, now).otherwise(F.col("old_at")).alias("updated_at"),
    )


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"]


def _versions(spark: SparkSession, table: str) -> Versions:
    return Versions(spark, f"{_location(spark, table)}/_versions")


def current_offsets(spark: SparkSession, table: str) -> DataFrame:
    """Newest version of the offsets table."""
    newest = _versions(spark, table).newest()
    return _version(spark, table, None if newest is None else newest[1]["data"])


def _version(spark: SparkSession, table: str, data: int | None) -> DataFrame:
    return spark.table(table).where(F.col("version") == F.lit(data).cast("long")).drop("version")


def update_offsets(spark: SparkSession, table: str, source: DataFrame) -> None:
    """Upsert ``source`` (pipeline_id, last_lsn) into the offsets table."""
    _change(spark, table, lambda current: merged_offsets(current, source))


def raised_offsets(target: DataFrame, source: DataFrame) -> DataFrame:
    """As ``merged_offsets``, but of the known and the given LSN the higher one stays."""
    old = target.select("pipeline_id", F.col("last_lsn").alias("old_lsn"), F.col("updated_at").alias("old_at"))
    new = source.select("pipeline_id", F.col("last_lsn").alias("new_lsn"), F.lit(True).alias("given"))
    old_number, new_number = lsn_number(F.col("old_lsn")), lsn_number(F.col("new_lsn"))
    higher = new_number.isNotNull() & (old_number.isNull() | (new_number > old_number))
    return old.join(new, "pipeline_id", "full_outer").select(
        "pipeline_id",
        F.when(higher, F.col("new_lsn")).otherwise(F.col("old_lsn")).alias("last_lsn"),
        F.when(F.col("given"), F.localtimestamp()).otherwise(F.col("old_at")).alias("updated_at"),
    )


def raise_offsets(spark: SparkSession, table: str, source: DataFrame) -> None:
    """As ``update_offsets``, for positions that never go back."""
    _change(spark, table, lambda current: raised_offsets(current, source))


def _change(spark: SparkSession, table: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Write the rows that ``merge`` makes of the newest version beside it, and let them be
    the newest if no other writer was faster; else merge again with what that one wrote,
    so no update is lost. The version before stays for readers that began with it."""
    create_offsets_table(spark, table)
    location = _location(spark, table)
    versions = Versions(spark, f"{location}/_versions")
    while True:
        number, newest = versions.newest() or (-1, {"data": None, "before": None})
        data = uuid.uuid4().int >> 66
        merged = merge(_version(spark, table, newest["data"]))
        # writers into one table would share its folder for unfinished files
        merged.select("pipeline_id", "last_lsn", "updated_at").coalesce(1).write.parquet(
            f"{location}/version={data}"
        )
        spark.sql(f"ALTER TABLE {table} ADD PARTITION (version = {data})")
        done = versions.publish(number + 1, {"data": data, "before": newest["data"]})
        unused = newest["before"] if done else data
        if unused is not None:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (version = {unused})")
        if done:
            if number > 0:
                versions.remove(number - 1)
            return


def last_offset(
    offsets: DataFrame, pipeline_id: int, columns: Sequence[str] = ("last_lsn",)
) -> DataFrame:
    """Offset of one pipeline: no row, or one whose LSN may be null."""
    return offsets.filter(F.col("pipeline_id") == pipeline_id).select(*columns).limit(1)


def resume_position(spark: SparkSession, table: str, pipeline_id: int) -> str | None:
    """LSN that a pipeline got to; None when it is not known."""
    create_offsets_table(spark, table)
    row = last_offset(current_offsets(spark, table), pipeline_id).first()
    return None if row is None else row["last_lsn"]
