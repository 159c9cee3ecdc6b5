"""Change tables in the session's catalog, one per source table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowharbor.functions.envelope import TABLE_SUFFIX
from rowharbor.sinks.dataset import PIECE_COLUMN, TABLE_COLUMN, change_rows
from rowharbor.sinks.landings import Landings, landings
from rowharbor.work_dir import files_below, remove_dir, work_dir

#: The table of landings that count, in the database of the change tables.
LANDINGS_TABLE = "LANDINGS"


def change_table_name(table_name: str, database: str = "default") -> str:
    return f"`{database}`.`{table_name.upper()}{TABLE_SUFFIX}`"


def ensure_change_table(
    spark: SparkSession, table_name: str, database: str = "default"
) -> None:
    """Create the change table of a source table unless it is there. Landings
    are its partitions."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {change_table_name(table_name, database)} (
            SCHEMA_DATABASE VARIANT,
            PAYLOAD VARIANT NOT NULL,
            OPERATION STRING NOT NULL,
            CREATED_AT TIMESTAMP_NTZ DEFAULT localtimestamp(),
            LAND_ID STRING
        ) USING parquet PARTITIONED BY (LAND_ID)"""
    )


def drop_change_table(
    spark: SparkSession, table_name: str, database: str = "default"
) -> None:
    """Drop a change table with its rows, if it is there."""
    spark.sql(f"DROP TABLE IF EXISTS {change_table_name(table_name, database)}")


def truncate_change_table(
    spark: SparkSession, table_name: str, database: str = "default"
) -> None:
    """A truncated source table leaves its change table as it is: a log is only
    ever added to."""


def _text(value: str) -> str:
    """A value as SQL text."""
    escaped = value.replace(chr(92), chr(92) * 2).replace("'", chr(92) + "'")
    return f"'{escaped}'"


def insert_changes(
    envelopes: DataFrame, table_name: str, land_id: str, database: str = "default"
) -> None:
    """Land one table's envelopes in its change table, which is created first.
    The same landing done again replaces itself."""
    spark = envelopes.sparkSession
    ensure_change_table(spark, table_name, database)
    target = change_table_name(table_name, database)
    rows = change_rows(envelopes)
    spark.sql(
        f"""INSERT OVERWRITE {target} PARTITION (LAND_ID = {_text(land_id)})
            SELECT schema_database, payload, operation, created_at FROM {{rows}}""",
        rows=rows,
    )


def insert_all(
    envelopes: DataFrame,
    table_names: list[str] | None,
    land_id: str,
    database: str = "default",
) -> None:
    """Land a mixed batch in the change tables of ``table_names``, one statement
    per table; with None, in those of all tables the batch has. Rows of a table
    that is not among the names fail the landing before anything is written. The batch is built once and put aside by table, so a statement
    reads its own rows only. Names that differ only in case share a change table.
    The dataset sink does the same in one job; this is for readers that want
    catalog tables."""
    spark = envelopes.sparkSession
    aside = work_dir(spark, "batch")
    try:
        envelopes.write.partitionBy("cdc_table").parquet(aside)
        batch = spark.read.schema(envelopes.schema).parquet(aside)
        found = {r[0].removesuffix(TABLE_SUFFIX) for r in batch.select("cdc_table").distinct().collect()}
        names = found if table_names is None else {name.upper() for name in table_names}
        if left_over := sorted(found - names):
            raise ValueError(f"rows of tables that are not to be landed: {left_over}")
        for name in sorted(names):
            own = batch.filter(F.col("cdc_table") == f"{name}{TABLE_SUFFIX}")
            insert_changes(own, name, land_id, database)
    finally:
        remove_dir(spark, aside)


def _rows_table(name: str, database: str) -> str:
    return f"`{database}`.`{name}_ROWS`"


def _register(spark: SparkSession, directory: str, land_id: str, part: str, database: str) -> None:
    """Let the tables of a landing have its directories as partitions."""
    for path, _ in files_below(spark, f"{directory}/{PIECE_COLUMN}=*/{TABLE_COLUMN}=*{TABLE_SUFFIX}"):
        name = path.rsplit("=", 1)[1]
        piece = path.rsplit("/", 2)[1].removeprefix(f"{PIECE_COLUMN}=")
        rows = _rows_table(name, database)
        spark.sql(
            f"""CREATE TABLE IF NOT EXISTS {rows} (
                SCHEMA_DATABASE VARIANT, PAYLOAD VARIANT, OPERATION STRING, CREATED_AT TIMESTAMP_NTZ,
                TS_MS LONG, PIPELINE_ID INT, LSN STRING, LAND_ID STRING, PART STRING, PIECE LONG
            ) USING parquet PARTITIONED BY (LAND_ID, PART, PIECE)"""
        )
        spark.sql(
            f"""ALTER TABLE {rows} ADD IF NOT EXISTS PARTITION
                (LAND_ID = {_text(land_id)}, PART = {_text(part)}, PIECE = {piece}) LOCATION {_text(path)}"""
        )
        spark.sql(
            f"""CREATE VIEW IF NOT EXISTS `{database}`.`{name}` AS
                SELECT r.SCHEMA_DATABASE, r.PAYLOAD, r.OPERATION, r.CREATED_AT, r.TS_MS, r.PIPELINE_ID, r.LSN,
                    r.LAND_ID
                FROM {rows} r LEFT SEMI JOIN `{database}`.`{LANDINGS_TABLE}` l
                    ON r.LAND_ID = l.LAND_ID AND r.PART = l.PART"""
        )


def register_landings(spark: SparkSession, root: str, database: str = "default") -> Landings:
    """Show a dataset's landings in the catalog: ``<TABLE>_CDC`` of every table.

    Rows are not written again. Every table has the landings' directories as its
    partitions, and a view on it shows those that the table ``LANDINGS`` names. That
    table's place is changed last, by one statement; so of a landing with many tables, or
    of a compaction, readers see all or nothing. Done again, nothing changes. One writer
    at a time for a database."""
    now = landings(spark, root)
    marker = f"`{database}`.`{LANDINGS_TABLE}`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {marker} (LAND_ID STRING, PART STRING) USING parquet")
    shown = {(r.LAND_ID, r.PART) for r in spark.table(marker).collect()}
    count = set(now.parts.items())
    if shown == count:
        return now
    for land_id, part in sorted(count - shown):
        _register(spark, f"{root}/{now.directory(land_id)}", land_id, part, database)
    path = f"{root}/_tables/{database}-{now.version:012d}-{uuid.uuid4().hex[:8]}"
    named = spark.createDataFrame(sorted(count), "LAND_ID STRING, PART STRING")
    named.coalesce(1).write.parquet(path)
    spark.sql(f"ALTER TABLE {marker} SET LOCATION {_text(path)}")
    spark.catalog.refreshTable(marker)
    for land_id, part in sorted(shown - count):
        for table in spark.catalog.listTables(database):
            if table.name.upper().endswith(f"{TABLE_SUFFIX}_ROWS"):
                spark.sql(
                    f"""ALTER TABLE `{database}`.`{table.name}` DROP IF EXISTS PARTITION
                        (LAND_ID = {_text(land_id)}, PART = {_text(part)})"""
                )
    return now
