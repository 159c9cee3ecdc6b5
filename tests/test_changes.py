import json

from pyspark.sql import functions as F

from helpers import log_of, lookup_of, payloads
from rowharbor.operators import changes


def landed(spark, *texts, **kwargs):
    log = log_of(spark, texts)
    return changes.text_envelopes(log, lookup_of(spark), keep=["n"], **kwargs)


def payload(spark, values, oid="16384"):
    text = f"Insert(InsertEvent {{ table_id: TableId({oid}), {values} }})"
    return payloads(landed(spark, text))[0]


def test_named_cells(spark):
    assert payload(spark, 'values: [I32(23), String("foo")]') == {
        "id": 23,
        "name": "foo",
    }


def test_missing_cells_get_no_name(spark):
    assert payload(spark, "values: [I32(1)]") == {"id": 1}


def test_cells_without_a_column(spark):
    got = payload(spark, "values: [I32(1), I32(2), I32(3), I32(4)]")
    assert got == {"id": 1, "name": 2, "col_2": 3, "col_3": 4}


def test_empty_list_is_one_empty_cell(spark):
    assert payload(spark, "values: []") == {"id": ""}


def test_no_list(spark):
    text = "Insert(InsertEvent { table_id: TableId(16384), nothing })"
    assert payload(spark, "nothing") == {"raw": text}


def test_separator_inside_a_cell(spark):
    got = payload(spark, 'values: [String("a, b"), I32(1)]')
    assert got == {"id": "a", "name": 'b")', "col_2": 1}


def test_list_stops_at_the_first_bracket(spark):
    got = payload(spark, "values: [I32(1), Array([1, 2]), I32(9)]")
    assert got == {"id": 1, "name": "[1", "col_2": "2"}


def test_table_without_columns(spark):
    assert payload(spark, "values: [I32(1), Null]", "16386") == {
        "col_0": 1,
        "col_1": "Null",
    }


def test_last_of_equal_names_wins(spark):
    assert payload(spark, "values: [I32(1), I32(2)]", "16385") == {"id": 2}
    assert payload(spark, "values: [I32(1)]", "16385") == {"id": 1}
    got = payload(spark, "values: [I32(1), I32(2), I32(3)]", "16389")
    assert got == {"id": 1, "col_2": 3}


def test_many_cells(spark):
    cells = ", ".join(f"I32({i})" for i in range(2000))
    got = payload(spark, f"values: [{cells}]")
    assert len(got) == 2000 and got["col_1999"] == 1999


def test_dropped_records(spark):
    texts = [
        "Begin(insert TableId(16384))",
        "Truncate(TableId(16384))",
        "Insert(TableId(16387), values: [I32(1)])",
        "Insert(TableId(5), values: [I32(1)])",
        "Insert(table_id: TableId(" + "1" * 21 + "), values: [I32(1)])",
        "Insert(TableId(16384), values: [I32(1)])",
    ]
    log, lookup = log_of(spark, texts), lookup_of(spark)
    kept = {r["n"] for r in changes.text_envelopes(log, lookup, ["n"]).collect()}
    reasons = {
        r["n"]: r["reason"] for r in changes.rejected_changes(log, lookup).collect()
    }
    assert kept == {5}
    assert reasons == {
        0: "control",
        1: "no operation",
        2: "no table",
        3: "no table",
        4: "no table",
    }


def test_envelope(spark):
    rows = landed(
        spark,
        "Update(TableId(16384), values: [I32(1)])",
        "Delete(TableId(16386), values: [I32(1)])",
    )
    users, bare = (
        rows.select("cdc_table", F.to_json("schema").alias("schema"), "op", "ts_ms")
        .orderBy("n")
        .collect()
    )
    assert (users["cdc_table"], users["op"]) == ("USERS_CDC", "u")
    assert users["ts_ms"] == 1_700_000_000_000
    assert json.loads(users["schema"]) == {
        "type": "struct",
        "fields": [
            {"field": "id", "type": "NUMBER(38,0)", "optional": True},
            {"field": "name", "type": "VARCHAR", "optional": True},
        ],
        "name": "users",
    }
    assert (bare["cdc_table"], bare["op"]) == ("BARE_CDC", "d")
    assert json.loads(bare["schema"]) == {"name": "bare"}


def test_large_lookup_joins_by_shuffle_with_the_same_result(spark):
    texts = [f"Insert(TableId({16384 + i % 4}), values: [I32({i})])" for i in range(99)]
    small = landed(spark, *texts)
    large = landed(spark, *texts, limit_bytes=0)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "strategy=broadcast" not in plan
    assert payloads(small) == payloads(large) and len(payloads(small)) == 75


def test_typed_records(spark):
    log = spark.sql(
        """SELECT * FROM VALUES
        (1, 16384, 'Insert', array(1::variant, 'insert, ] x'::variant)),
        (2, 16384, 'UPDATE', array(2::variant, NULL)),
        (3, 16385, 'delete', array(2::variant, parse_json('[1, null]'))),
        (4, 16386, 'delete', CAST(array() AS array<variant>)),
        (5, 16384, 'truncate', array(1::variant)),
        (6, 5, 'insert', array(1::variant)) AS t(n, table_oid, kind, cells)"""
    ).withColumn("commit_ts", F.current_timestamp())
    rows = changes.typed_envelopes(log, lookup_of(spark), keep=["n"])
    assert payloads(rows) == {
        1: {"id": 1, "name": "insert, ] x"},
        2: {"id": 2, "name": None},
        3: {"id": [1, None]},
        4: {},
    }
    ops = {r["n"]: r["op"] for r in rows.collect()}
    assert ops == {1: "c", 2: "u", 3: "d", 4: "d"}


def test_lookup_scoped_by_source(spark):
    """Two sources may use one oid for different tables."""
    from rowharbor.operators.catalog import table_columns, table_lookup
    from rowharbor.operators.lookup import measured

    columns = spark.createDataFrame(
        [(1, "7", "a", 1, "x", "int4"), (2, "7", "b", 1, "y", "int4")],
        "pipeline_id int, oid string, relname string, attnum int, attname string, "
        "typname string",
    )
    lookup = measured(table_lookup(table_columns(columns, ["pipeline_id", "oid"])))
    log = log_of(spark, ["Insert(TableId(7), values: [I32(1)])"] * 2).withColumn(
        "pipeline_id", F.col("n") + 1
    )
    rows = changes.text_envelopes(
        log, lookup, keep=["n"], scope=["pipeline_id"]
    )
    assert payloads(rows) == {0: {"x": 1}, 1: {"y": 1}}
