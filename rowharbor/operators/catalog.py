"""From the source's catalogs to one row per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowharbor.functions.cells import ambiguous_names
from rowharbor.functions.envelope import schema_object


def catalog_columns(
    pg_class: DataFrame,
    pg_namespace: DataFrame,
    pg_publication_tables: DataFrame,
    pg_attribute: DataFrame,
    pg_type: DataFrame,
    publication: str,
) -> DataFrame:
    """Live columns of the tables of one publication: oid (text), relname,
    attnum, attname, typname, nspname. System and dropped columns are left out."""
    published = pg_publication_tables.filter(F.col("pubname") == publication)
    classes = pg_class.select("oid", "relname", "relnamespace")
    namespaces = pg_namespace.select(F.col("oid").alias("nsp_oid"), "nspname")
    types = pg_type.select(F.col("oid").alias("type_oid"), "typname")
    live = pg_attribute.filter("attnum > 0 AND NOT attisdropped").select(
        "attrelid", "attname", "atttypid", "attnum"
    )
    return (
        classes.join(namespaces, F.col("relnamespace") == F.col("nsp_oid"))
        .join(
            published.select("tablename", "schemaname"),
            (F.col("relname") == F.col("tablename"))
            & (F.col("nspname") == F.col("schemaname")),
        )
        .join(live, F.col("oid") == F.col("attrelid"))
        .join(types, F.col("atttypid") == F.col("type_oid"))
        .select(
            F.col("oid").cast("string").alias("oid"),
            "relname",
            "attnum",
            "attname",
            "typname",
            "nspname",
        )
    )


def order_catalog(columns: DataFrame) -> DataFrame:
    """Catalog rows by numeric oid, then column number."""
    return columns.orderBy(F.col("oid").cast("long"), "attnum")


def table_columns(columns: DataFrame, keys: Sequence[str] = ("oid",)) -> DataFrame:
    """One row per table: its name, its columns in column order and, if the columns have
    it, its schema. A table has at most some 1600 columns, so the lists are bounded."""
    spaced = [F.max("nspname").alias("schema_name")] if "nspname" in columns.columns else []
    ordered = F.array_sort(F.collect_list(F.struct("attnum", "attname", "typname")))
    return (
        columns.groupBy(*keys)
        .agg(F.max("relname").alias("table_name"), ordered.alias("ordered"), *spaced)
        .withColumn(
            "columns",
            F.transform(
                "ordered",
                lambda c: F.struct(
                    c["attname"].alias("name"), c["typname"].alias("pg_type")
                ),
            ),
        )
        .drop("ordered")
    )


def table_lookup(tables: DataFrame) -> DataFrame:
    """What rows need to know about their table, worked out once per table:
    names of its columns, whether names can clash, and its schema object. The
    input has the table's key, ``table_name`` and ``columns`` (may be null)."""
    names = F.transform("columns", lambda c: c["name"])
    return (
        tables.withColumn("names", names)
        .withColumn("ambiguous", ambiguous_names(F.col("names")))
        .withColumn(
            "schema",
            F.when(
                F.col("columns").isNotNull(),
                schema_object(F.col("table_name"), F.col("columns")),
            ),
        )
    )


def mapped_tables(columns: DataFrame) -> DataFrame:
    """Number of tables the catalog maps."""
    return columns.agg(F.count_distinct("oid").alias("mapped_tables"))
