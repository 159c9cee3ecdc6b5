import json

from pyspark.sql import functions as F

from helpers import log_of, lookup_of, payloads
from rowharbor.operators import changes, packing


def envelopes(spark, count):
    texts = [f"Insert(TableId({16384 + i % 3}), values: [I32({i})])" for i in range(count)]
    return changes.text_envelopes(log_of(spark, texts), lookup_of(spark), keep=["n"])


def test_batches_are_bounded_and_ordered(spark):
    batches = packing.packed_batches(envelopes(spark, 50), "n", 20).collect()
    assert {(b["cdc_table"], b["batch"]) for b in batches} == {
        (t, n) for t in ("USERS_CDC", "TWINS_CDC", "BARE_CDC") for n in range(3)
    }
    users = next(b for b in batches if (b["cdc_table"], b["batch"]) == ("USERS_CDC", 1))
    parsed = json.loads(users["batch_json"])
    assert [e["payload"]["id"] for e in parsed] == [21, 24, 27, 30, 33, 36, 39]
    assert set(parsed[0]) == {"schema", "payload", "op", "ts_ms"}


def test_flatten_gives_the_rows_back(spark):
    rows = envelopes(spark, 50)
    flat = packing.flattened_batches(packing.packed_batches(rows, "n", 20))
    assert flat.columns == ["cdc_table", "schema_database", "payload", "operation"]
    ids = flat.select(
        F.coalesce(
            F.variant_get("payload", "$.id", "int"),
            F.variant_get("payload", "$.col_0", "int"),
        )
    )
    assert sorted(r[0] for r in ids.collect()) == list(range(50))
    assert len(payloads(rows)) == 50


def test_batches_of_any_sequence_are_bounded(spark):
    rows = envelopes(spark, 900).withColumn("same", F.lit(7)).withColumn("gaps", F.col("n") * 1000)
    for sequence in ("same", "gaps"):
        batches = packing.bounded_batches(rows, sequence, 40).collect()
        sizes = [len(json.loads(b["batch_json"])) for b in batches]
        assert sum(sizes) == 900 and max(sizes) <= 40 and len(sizes) < 60
    ids = [
        [e["payload"]["id"] for e in json.loads(b["batch_json"])]
        for b in sorted(batches, key=lambda b: b["batch"]) if b["cdc_table"] == "USERS_CDC"
    ]
    assert [i for batch in ids for i in batch] == list(range(0, 900, 3))


def test_empty_batch(spark):
    rows = envelopes(spark, 3).filter("n < 0")
    assert packing.packed_batches(rows, "n").count() == 0
    assert packing.bounded_batches(rows, "n").count() == 0
    empty = spark.createDataFrame([("X_CDC", "[]")], "cdc_table string, batch_json string")
    assert packing.flattened_batches(empty).count() == 0
