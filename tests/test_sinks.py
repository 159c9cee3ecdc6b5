import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import log_of, lookup_of
from rowharbor.operators import changes
from rowharbor.sinks import dataset, tables


def envelopes(spark, count=30, only=None):
    texts = [
        f"Insert(TableId({only or 16384 + i % 3}), values: [I32({i})])"
        for i in range(count)
    ]
    return changes.text_envelopes(log_of(spark, texts), lookup_of(spark))


def counts(df, *by):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*by).count().collect()}


@pytest.mark.parametrize("compact", [False, True])
def test_one_job_writes_every_table(spark, tmp_path, compact):
    root = str(tmp_path)
    dataset.land(envelopes(spark), root, "a", compact)
    landed = dataset.read_landed(spark, root)
    assert counts(landed, "cdc_table", "operation") == {
        ("USERS_CDC", "c"): 10,
        ("TWINS_CDC", "c"): 10,
        ("BARE_CDC", "c"): 10,
    }
    row = landed.filter("cdc_table = 'BARE_CDC'").select(
        F.to_json("payload").alias("p"), F.to_json("schema_database").alias("s"),
        "created_at", "ts_ms", "pipeline_id",
    ).first()
    assert list(json.loads(row["p"])) == ["col_0"] and row["s"] == '{"name":"bare"}'
    assert row["created_at"] is not None and row["ts_ms"] == 1_700_000_000_000


def test_a_landing_done_again_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    dataset.land(envelopes(spark), root, "a")
    dataset.land(envelopes(spark, 9), root, "b")
    dataset.land(envelopes(spark, 12), root, "a")
    assert counts(dataset.read_landed(spark, root), "land_id") == {("a",): 12, ("b",): 9}


def test_empty_landing(spark, tmp_path):
    root = str(tmp_path)
    dataset.land(envelopes(spark).limit(0), root, "a")
    dataset.land(envelopes(spark, 3), root, "b")
    assert counts(dataset.read_landed(spark, root), "land_id") == {("b",): 3}


def test_one_table_prunes_directories(spark, tmp_path):
    root = str(tmp_path)
    dataset.land(envelopes(spark), root, "a")
    users = dataset.read_change_table(spark, root, "users")
    assert users.count() == 10
    plan = users._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cdc_table" in plan


def test_text_schema_column_becomes_a_variant(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    spark.sql(
        """SELECT * FROM VALUES ('{"name":"users"}', 'A_CDC'), ('not json', 'A_CDC'),
        (NULL, 'B_CDC') AS t(schema_database, cdc_table)"""
    ).withColumn("payload", F.parse_json(F.lit("{}"))).withColumn(
        "land_id", F.lit("x")
    ).write.partitionBy("land_id", "cdc_table").parquet(old)
    want = {("A_CDC", '{"name":"users"}'), ("A_CDC", '"not json"'), ("B_CDC", None)}

    def rows(df):
        return {tuple(r) for r in df.select("cdc_table", F.to_json("schema_database")).collect()}

    assert rows(dataset.read_migrating(spark, old, new)) == want
    assert dataset.migrate_schema_column(spark, old, new) == ["x"]
    assert dataset.migrate_schema_column(spark, old, new) == []
    assert rows(dataset.read_landed(spark, new)) == want
    assert rows(dataset.read_migrating(spark, old, new)) == want
    assert spark.read.parquet(old).schema["schema_database"].dataType.typeName() == "string"


def test_catalog_tables(spark):
    name = tables.change_table_name("Users")
    assert name == "`default`.`USERS_CDC`"
    tables.drop_change_table(spark, "users")
    tables.ensure_change_table(spark, "users")
    tables.ensure_change_table(spark, "USERS")
    assert spark.table(name).columns == [
        "SCHEMA_DATABASE", "PAYLOAD", "OPERATION", "CREATED_AT", "LAND_ID",
    ]
    tables.insert_changes(envelopes(spark, 5, only=16384), "users", "a")
    tables.insert_changes(envelopes(spark, 4, only=16384), "users", "b")
    tables.insert_changes(envelopes(spark, 3, only=16384), "users", "a")
    tables.truncate_change_table(spark, "users")
    rows = spark.table(name)
    assert counts(rows, "LAND_ID") == {("a",): 3, ("b",): 4}
    ids = rows.select(F.variant_get("PAYLOAD", "$.id", "int")).collect()
    assert sorted(r[0] for r in ids) == [0, 0, 1, 1, 2, 2, 3]
    spark.sql(
        f"INSERT INTO {name} (PAYLOAD, OPERATION, LAND_ID) "
        "VALUES (parse_json('{}'), 'c', 'hand')"
    )
    assert spark.table(name).filter("CREATED_AT IS NULL").count() == 0
    tables.drop_change_table(spark, "users")
    assert not spark.catalog.tableExists(name)
    tables.drop_change_table(spark, "users")


def test_mixed_batch_into_catalog_tables(spark):
    names = ["users", "Users", "twins", "bare"]
    tables.insert_all(envelopes(spark), names, "a")
    for name in ("users", "twins", "bare"):
        assert spark.table(tables.change_table_name(name)).count() == 10
        tables.drop_change_table(spark, name)


def test_files_stay_few_when_compacted(spark, tmp_path):
    wide = envelopes(spark, 60).repartition(8)
    for land_id, compact in (("plain", False), ("compact", True)):
        dataset.land(wide, str(tmp_path), land_id, compact)

    def files(land_id):
        found = os.walk(tmp_path / f"land_id={land_id}")
        return sum(f.endswith(".parquet") for _, _, names in found for f in names)

    assert files("compact") <= 3 * 3 < files("plain")


def test_insert_all_leaves_no_table_out(spark):
    for name in ("users", "twins", "bare"):
        tables.drop_change_table(spark, name)
    with pytest.raises(ValueError, match="BARE"):
        tables.insert_all(envelopes(spark), ["users", "twins"], "a")
    tables.insert_all(envelopes(spark), None, "a")
    total = sum(
        spark.table(tables.change_table_name(r["cdc_table"].removesuffix("_CDC"))).count()
        for r in envelopes(spark).select("cdc_table").distinct().collect()
    )
    assert total == envelopes(spark).count()


def test_landing_again_replaces_itself_in_dynamic_mode(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    root, rows = str(tmp_path), envelopes(spark)
    spark.conf.set(key, "dynamic")
    try:
        dataset.land(rows, root, "a")
        dataset.land(rows.filter("cdc_table = 'USERS_CDC'"), root, "a")
    finally:
        spark.conf.unset(key)
    assert set(counts(dataset.read_landed(spark, root), "cdc_table")) == {("USERS_CDC",)}


def test_old_work_is_removed_and_nothing_else(spark, tmp_path, monkeypatch):
    from rowharbor import work_dir

    monkeypatch.setattr(work_dir, "_shared_folder", lambda spark: str(tmp_path))
    own = work_dir.work_dir(spark, "mine")
    for path in (own, str(tmp_path / "theirs"), str(tmp_path / "uuid-1-2-3")):
        spark.range(1).write.parquet(path)
    assert work_dir.remove_old_work(spark, 1) == []
    assert [p.rsplit("/", 1)[1] for p in work_dir.remove_old_work(spark, -1)] == [own.rsplit("/", 1)[1]]
    assert sorted(os.listdir(tmp_path)) == ["theirs", "uuid-1-2-3"]
