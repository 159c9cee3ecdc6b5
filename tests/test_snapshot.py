import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import TABLE_SCHEMA, USERS, lookup_of, payloads
from rowharbor.operators import snapshot
from rowharbor.operators.catalog import table_lookup
from rowharbor.operators.lookup import measured


def printed(spark, *rows):
    return spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(rows)],
        "n int, table_id string, row_text string",
    ).withColumn("read_ts", F.timestamp_seconds(F.lit(5)))


def test_printed_rows(spark):
    rows = printed(
        spark,
        ("TableId(16384)", 'TableRow { values: [I32(1), String("x")] }'),
        ("TableId { schema: 1, table: 16385 }", "TableRow(I32(1), Null)"),
        ("TableId { table: users }", "TableRow(I32(1))"),
        ("TableId(7)", "TableRow(I32(1))"),
        ('TableId { table: "16384" }', "TableRow [I32(1)]"),
        ("TableId(16386)", "TableRow(I32(1))"),
        ("TableId { x: 16385, table: t16384 }", "TableRow(I32(1), I32(2))"),
    )
    got = snapshot.text_snapshot(rows, lookup_of(spark), keep=["n"])
    assert payloads(got) == {
        0: {"id": 1, "name": "x"},
        1: {"id": "Null"},
        2: {"data": "TableRow(I32(1))"},
        3: {"data": "TableRow(I32(1))"},
        4: {"id": 1},
        5: {"data": "TableRow(I32(1))"},
        6: {"id": 2},
    }
    meta = got.select("n", "cdc_table", "op", "ts_ms", F.to_json("schema").alias("s"))
    rows = {r["n"]: r for r in meta.collect()}
    # An id that is not found lands under itself: '0' digits name no table here.
    assert [rows[n]["cdc_table"] for n in range(7)] == [
        "USERS_CDC",
        "TWINS_CDC",
        "USERS_CDC",
        "7_CDC",
        "_CDC",
        "BARE_CDC",
        "T16384_CDC",
    ]
    assert {r["op"] for r in rows.values()} == {"c"}
    assert {r["ts_ms"] for r in rows.values()} == {5000}
    assert rows[3]["s"] == "{}" and rows[5]["s"] == "{}"
    assert json.loads(rows[0]["s"])["name"] == "users"
    # Columns found by the oid, but under the name the id gave.
    assert json.loads(rows[4]["s"])["name"] == ""
    assert json.loads(rows[6]["s"])["name"] == "t16384"


def test_printed_rows_by_shuffle(spark):
    rows = printed(spark, *[("TableId(16384)", f"TableRow(I32({i}))") for i in range(40)])
    small = snapshot.text_snapshot(rows, lookup_of(spark), keep=["n"])
    large = snapshot.text_snapshot(rows, lookup_of(spark), keep=["n"], limit_bytes=0)
    assert payloads(small) == payloads(large) == {i: {"id": i} for i in range(40)}


def test_typed_rows_keep_types_and_nulls(spark):
    rows = spark.sql(
        """SELECT 1 AS id, CAST(NULL AS string) AS name, 1.50BD AS price,
        array(1, NULL) AS tags, DATE '2024-01-02' AS day,
        TIMESTAMP '2024-01-02 03:04:05' AS at"""
    )
    got = snapshot.typed_snapshot(rows, lookup_of(spark), "16384").select(
        "cdc_table",
        "op",
        F.to_json("payload").alias("p"),
        F.variant_get("payload", "$.price", "decimal(9,2)").alias("price"),
    )
    row = got.first()
    assert (row["cdc_table"], row["op"], row["price"]) == (
        "USERS_CDC",
        "c",
        Decimal("1.50"),
    )
    payload = json.loads(row["p"])
    assert payload["id"] == 1 and payload["name"] is None
    assert payload["tags"] == [1, None] and payload["day"] == "2024-01-02"
    assert payload["at"].startswith("2024-01-02 03:04:05")


def test_typed_rows_of_a_table_without_columns(spark):
    rows = spark.createDataFrame([(1, "x", 9)], "id int, name string, seq int")
    for oid, table in (("16386", "BARE_CDC"), ("5", "5_CDC")):
        got = snapshot.typed_snapshot(rows, lookup_of(spark), oid, keep=["seq"])
        row = got.select(
            "cdc_table", "seq", F.to_json("payload"), F.to_json("schema")
        ).first()
        assert tuple(row)[:2] == (table, 9)
        assert json.loads(json.loads(row[2])["data"]) == {"id": 1, "name": "x"}
        assert row[3] == "{}"


def test_scope_tells_equal_ids_apart(spark):
    both = [(1, *USERS), (2, "16384", "orders", [("id", "int4"), ("total", "numeric")])]
    lookup = measured(
        table_lookup(spark.createDataFrame(both, f"pipeline_id int, {TABLE_SCHEMA}"))
    )
    rows = spark.createDataFrame([(1, 2.5), (2, 3.5)], "id int, total double")
    with pytest.raises(ValueError, match="several"):
        snapshot.typed_snapshot(rows, lookup, "16384")
    got = snapshot.typed_snapshot(rows, lookup, "16384", scope={"pipeline_id": 2}).collect()
    assert [(r["cdc_table"], r["pipeline_id"]) for r in got] == [("ORDERS_CDC", 2)] * 2
    text = spark.createDataFrame([(2, "TableId(16384)", "x")], "pipeline_id int, table_id string, row_text string")
    assert [r["table_name"] for r in snapshot.located_rows(text, lookup, scope=("pipeline_id",)).collect()] == ["orders"]
