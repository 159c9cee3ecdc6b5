import json

from pyspark.sql import functions as F

from rowharbor.operators import catalog
from rowharbor.operators.lookup import measured, stored


def catalogs(spark):
    return [
        spark.createDataFrame(
            [(16400, "orders", 10), (9000, "users", 10), (16401, "orders", 11),
             (16402, "private", 10)],
            "oid long, relname string, relnamespace long",
        ),
        spark.createDataFrame([(10, "public"), (11, "archive")], "oid long, nspname string"),
        spark.createDataFrame(
            [("pub", "public", "orders"), ("pub", "public", "users"),
             ("other", "archive", "orders"), ("other", "public", "private")],
            "pubname string, schemaname string, tablename string",
        ),
        spark.createDataFrame(
            [(16400, "total", 23, 2, False), (16400, "id", 20, 1, False),
             (16400, "ctid", 27, -1, False), (16400, "gone", 23, 3, True),
             (16400, "at", 1184, 10, False), (9000, "id", 20, 1, False),
             (16401, "id", 20, 1, False), (16402, "id", 20, 1, False)],
            "attrelid long, attname string, atttypid long, attnum int, "
            "attisdropped boolean",
        ),
        spark.createDataFrame(
            [(20, "int8"), (23, "int4"), (27, "tid"), (1184, "timestamptz")],
            "oid long, typname string",
        ),
    ]


def test_columns_of_one_publication_in_order(spark):
    columns = catalog.catalog_columns(*catalogs(spark), "pub")
    rows = [tuple(r) for r in catalog.order_catalog(columns).collect()]
    assert rows == [
        ("9000", "users", 1, "id", "int8", "public"),
        ("16400", "orders", 1, "id", "int8", "public"),
        ("16400", "orders", 2, "total", "int4", "public"),
        ("16400", "orders", 10, "at", "timestamptz", "public"),
    ]


def test_one_row_per_table(spark):
    columns = catalog.catalog_columns(*catalogs(spark), "pub")
    got = {
        r["oid"]: (r["table_name"], [tuple(c) for c in r["columns"]])
        for r in catalog.table_columns(columns).collect()
    }
    assert got == {
        "9000": ("users", [("id", "int8")]),
        "16400": ("orders", [("id", "int8"), ("total", "int4"), ("at", "timestamptz")]),
    }
    assert catalog.mapped_tables(columns).first()[0] == 2


def test_unknown_publication_maps_nothing(spark):
    columns = catalog.catalog_columns(*catalogs(spark), "nope")
    assert catalog.table_columns(columns).count() == 0
    assert catalog.mapped_tables(columns).first()[0] == 0
    assert measured(catalog.table_lookup(catalog.table_columns(columns))).size_bytes == 0


def test_lookup_holds_the_schema_object(spark, tmp_path):
    columns = catalog.catalog_columns(*catalogs(spark), "other")
    lookup = stored(
        catalog.table_lookup(catalog.table_columns(columns)), str(tmp_path / "lookup")
    )
    rows = lookup.df.select("oid", "ambiguous", F.to_json("schema").alias("s")).collect()
    assert {r["oid"] for r in rows} == {"16401", "16402"}
    assert not any(r["ambiguous"] for r in rows)
    schema = json.loads(next(r["s"] for r in rows if r["oid"] == "16401"))
    assert schema == {
        "type": "struct",
        "fields": [{"field": "id", "type": "NUMBER(38,0)", "optional": True}],
        "name": "orders",
    }
    assert lookup.size_bytes > 0
