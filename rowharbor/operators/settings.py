"""The pipeline settings table, and what a new version of it asks for."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowharbor.sinks.versions import Versions

# The settings a pipeline is defined by, and unsigned ranges.
SETTINGS_TABLE = "tblsetting_etl_source"
SETTINGS = (
    "id",
    "host",
    "port",
    "username",
    "password",
    "dbname",
    "publication_name",
    "replication_id",
)
PORT_MASK = 65535
UNSIGNED_LONG_RANGE = "18446744073709551616"

START = "start"
STOP = "stop"
RESTART = "restart"
KEEP = "keep"


def create_settings_table(spark: SparkSession, table: str = SETTINGS_TABLE) -> None:
    """Create the settings table unless it is there."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {table} (
            id INT NOT NULL,
            host STRING NOT NULL,
            port INT NOT NULL,
            username STRING NOT NULL,
            password STRING NOT NULL,
            dbname STRING NOT NULL,
            publication_name STRING NOT NULL,
            replication_id BIGINT NOT NULL,
            created_at TIMESTAMP_NTZ DEFAULT localtimestamp(),
            updated_at TIMESTAMP_NTZ DEFAULT localtimestamp()
        ) USING parquet"""
    )


def unsigned_port(port: Column) -> Column:
    """A port in 16 unsigned bits; larger and negative values wrap."""
    return port.bitwiseAND(F.lit(PORT_MASK)).cast("int")


def unsigned_id(replication_id: Column) -> Column:
    """A signed 64-bit id read as unsigned."""
    wide = replication_id.cast("decimal(20,0)")
    return F.when(
        replication_id < 0, wide + F.lit(UNSIGNED_LONG_RANGE).cast("decimal(20,0)")
    ).otherwise(wide).cast("decimal(20,0)")


def pipeline_settings(table: DataFrame) -> DataFrame:
    """Settings of all pipelines, without the table's times."""
    return table.select(*SETTINGS).withColumns(
        {
            "port": unsigned_port(F.col("port")),
            "replication_id": unsigned_id(F.col("replication_id")),
        }
    )


def pipeline_ids(settings: DataFrame) -> DataFrame:
    return settings.select("id").distinct()


def stopped_ids(running: DataFrame, desired: DataFrame) -> DataFrame:
    """Ids that run but are no longer in the settings."""
    return pipeline_ids(running).join(pipeline_ids(desired), "id", "left_anti")


def pipeline_actions(running: DataFrame, desired: DataFrame) -> DataFrame:
    """``id`` and ``action`` for every pipeline of either side: start, stop,
    restart when any setting changed (null equals null), else keep."""
    old = running.select("id", F.struct(*SETTINGS).alias("old"))
    new = desired.select("id", F.struct(*SETTINGS).alias("new"))
    action = (
        F.when(F.col("old").isNull(), F.lit(START))
        .when(F.col("new").isNull(), F.lit(STOP))
        .when(F.col("old").eqNullSafe(F.col("new")), F.lit(KEEP))
        .otherwise(F.lit(RESTART))
    )
    return old.join(new, "id", "full_outer").select("id", action.alias("action"))


def running_after(running: DataFrame, desired: DataFrame, actions: DataFrame) -> DataFrame:
    """What runs once ``actions`` (id, action) were taken: started and restarted pipelines
    with the desired settings, the others as before; an action that is not among them
    was not taken."""
    taken = actions.select(F.col("id").alias("acted"), "action")
    old = running.select("id", F.struct(*SETTINGS).alias("old"))
    new = desired.select("id", F.struct(*SETTINGS).alias("new"))
    both = old.join(new, "id", "full_outer").join(taken, F.col("id") == F.col("acted"), "left")
    now = (
        F.when(F.col("action").isin(START, RESTART), F.col("new"))
        .when(F.col("action") == STOP, F.lit(None))
        .otherwise(F.col("old"))
    )
    return both.select(now.alias("now")).where("now IS NOT NULL").select("now.*")


class RunningSet:
    """The settings that pipelines were started with, kept in a directory from poll to
    poll. What a version asks for is said against these, not against the version before:
    an action that was not taken is asked for again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.versions = Versions(spark, f"{path}/versions")

    def running(self) -> DataFrame | None:
        """What runs as of the last poll; None before the first."""
        newest = self.versions.newest()
        return None if newest is None else self.spark.read.parquet(f"{self.path}/{newest[1]}")

    def poll(self, desired: DataFrame) -> DataFrame:
        """The actions that the settings ask for now."""
        running = self.running()
        return pipeline_actions(desired.limit(0) if running is None else running, desired)

    def took(self, desired: DataFrame, actions: DataFrame) -> None:
        """Note the actions of a poll that were taken."""
        newest = self.versions.newest()
        number = 0 if newest is None else newest[0] + 1
        running = desired.limit(0) if newest is None else self.running()
        name = f"running-{uuid.uuid4().hex}"
        running_after(running, desired, actions).write.parquet(f"{self.path}/{name}")
        if not self.versions.publish(number, name):
            raise ValueError(f"{self.path} is polled by another")
