"""Small tables that the tests share."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from rowharbor.operators.catalog import table_lookup
from rowharbor.operators.lookup import measured

TABLE_SCHEMA = (
    "oid string, table_name string, columns array<struct<name:string,pg_type:string>>"
)
USERS = ("16384", "users", [("id", "int4"), ("name", "text")])
TWINS = ("16385", "twins", [("id", "int4"), ("id", "int4")])
BARE = ("16386", "bare", None)
UNKNOWN = ("16387", "unknown_table", [("id", "int4")])
CLASHING = ("16389", "clashing", [("id", "int4"), ("col_2", "int4")])
TABLES = [USERS, TWINS, BARE, UNKNOWN, CLASHING]


def lookup_of(spark, tables=None):
    return measured(table_lookup(spark.createDataFrame(tables or TABLES, TABLE_SCHEMA)))


def log_of(spark, texts):
    return (
        spark.createDataFrame(list(enumerate(texts)), "n int, event_text string")
        .withColumn("commit_ts", F.timestamp_seconds(F.lit(1_700_000_000)))
    )


def payloads(envelopes, key="n"):
    """Payload by key; numbers keep whether they are whole."""
    rows = envelopes.select(key, F.to_json("payload").alias("p")).collect()
    return {r[0]: json.loads(r["p"]) for r in rows}
