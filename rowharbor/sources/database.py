"""Reading the source database and the settings database over JDBC.

Every reader takes Spark's own JDBC options (url, user, password, driver, ...).
Filters and column lists are pushed into the database by Spark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from rowharbor.operators.catalog import catalog_columns
from rowharbor.operators.settings import SETTINGS_TABLE, pipeline_settings

# The catalogs that describe a publication's tables.
CATALOGS = (
    "pg_class",
    "pg_namespace",
    "pg_publication_tables",
    "pg_attribute",
    "pg_type",
)
SNAPSHOT_PARTITIONS = 4


def postgres_options(settings: Mapping[str, object]) -> dict[str, str]:
    """JDBC options of one pipeline's settings row."""
    return {
        "url": f"jdbc:postgresql://{settings['host']}:{settings['port']}"
        f"/{settings['dbname']}",
        "user": str(settings["username"]),
        "password": str(settings["password"]),
        "driver": "org.postgresql.Driver",
    }


def _reader(spark: SparkSession, options: Mapping[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").options(**options)


def read_settings(
    spark: SparkSession, options: Mapping[str, str], table: str = SETTINGS_TABLE
) -> DataFrame:
    """Settings of all pipelines."""
    return pipeline_settings(_reader(spark, options).option("dbtable", table).load())


def read_catalog(
    spark: SparkSession, options: Mapping[str, str], publication: str
) -> DataFrame:
    """Live columns of a publication's tables, from the database's catalogs."""
    tables = [
        _reader(spark, options).option("dbtable", name).load() for name in CATALOGS
    ]
    return catalog_columns(*tables, publication)


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = SNAPSHOT_PARTITIONS,
) -> DataFrame:
    """All rows of a table for its initial copy. With a number, date or timestamp
    ``column`` and its range, ``partitions`` tasks read a slice each; rows outside
    the range are read too, by the first and the last slice."""
    reader = _reader(spark, options).option("dbtable", table)
    if column is not None:
        reader = reader.options(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()
