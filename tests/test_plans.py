"""What the plans look like: what is read, moved and broadcast."""

import pytest
from pyspark.sql import functions as F

from helpers import lookup_of
from rowharbor.operators import catalog, changes, lookup, offsets, snapshot
from rowharbor.sources.spread import spread


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    spark.range(100).selectExpr(
        "CAST(id % 3 AS int) AS pipeline_id",
        "concat('0/', hex(id)) AS lsn",
        "TIMESTAMP '2024-01-01 00:00:00' AS commit_ts",
        "16384 + id % 2 AS table_oid",
        "'insert' AS kind",
        "array(CAST(id AS variant)) AS cells",
        "concat('Insert(TableId(16384), values: [I64(', id, ')])') AS event_text",
        "'unused' AS unused",
    ).write.parquet(f"{root}/log")
    return spark.read.parquet(f"{root}/log")


def exchanges(text):
    return text.count("Exchange hashpartitioning"), text.count("BroadcastExchange")


def test_landing_a_text_log_moves_no_rows(spark, logs):
    text = plan(changes.text_envelopes(logs, lookup_of(spark), ["lsn"]))
    assert exchanges(text) == (0, 1)
    assert "Python" not in text and "SortMergeJoin" not in text
    read = text[text.index("ReadSchema") :]
    assert "unused" not in read and "cells" not in read


def test_landing_a_typed_log_moves_no_rows(spark, logs):
    text = plan(changes.typed_envelopes(logs, lookup_of(spark), ["lsn"]))
    assert exchanges(text) == (0, 1)
    assert "event_text" not in text[text.index("ReadSchema") :]


def test_control_records_are_dropped_before_anything_else(spark, logs):
    text = plan(changes.text_envelopes(logs, lookup_of(spark)))
    on_text = text.index("Filter ((isnotnull(event_text")
    assert on_text > text.index("split(") and "RLIKE" in text[on_text:]
    assert text[on_text:].splitlines()[1].strip(" :+-").startswith("FileScan")


def test_a_snapshot_moves_no_rows(spark):
    rows = spark.range(10).withColumn("name", F.lit("x"))
    text = plan(snapshot.typed_snapshot(rows, lookup_of(spark), "16384"))
    assert exchanges(text) == (0, 0) and "Join" not in text


def test_a_large_lookup_is_not_broadcast(spark, logs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = lookup.Lookup(lookup_of(spark).df, lookup.BROADCAST_LIMIT_BYTES + 1)
        text = plan(changes.text_envelopes(logs, big, ["lsn"]))
        assert exchanges(text) == (2, 0) and "_salt" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_table_is_spread_over_the_salts(spark, logs):
    hot = spark.range(3200).selectExpr("concat('Insert(', id, ')') AS event_text")
    salt = F.pmod(F.xxhash64("event_text"), F.lit(lookup.SALTS))
    sizes = [r["count"] for r in hot.groupBy(salt).count().collect()]
    assert len(sizes) == lookup.SALTS and max(sizes) < 2 * 3200 / lookup.SALTS


def test_positions_are_reduced_before_the_shuffle(spark, logs):
    text = plan(offsets.latest_positions(logs))
    first = text.index("partial_max(packed")
    assert "HashAggregate" in text[:first].splitlines()[-1] and exchanges(text)[1] == 0
    assert "event_text" not in text[text.index("ReadSchema") :]


def test_catalog_filters_reach_the_files(spark, tmp_path):
    frames = {
        "pg_class": "1L AS oid, 't' AS relname, 1L AS relnamespace, 'x' AS other",
        "pg_namespace": "1L AS oid, 'n' AS nspname, 'x' AS other",
        "pg_publication_tables": "'p' AS pubname, 'n' AS schemaname, 't' AS tablename",
        "pg_attribute": "1L AS attrelid, 'c' AS attname, 1L AS atttypid, 1 AS attnum, "
        "false AS attisdropped, 'x' AS other",
        "pg_type": "1L AS oid, 'int4' AS typname, 'x' AS other",
    }
    tables = []
    for name, columns in frames.items():
        spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    columns = catalog.catalog_columns(*tables, "p")
    text = plan(columns)
    assert "EqualTo(pubname,p)" in text
    assert "GreaterThan(attnum,0)" in text and "attisdropped" in text
    assert "other" not in text
    assert [tuple(r) for r in columns.collect()] == [("1", "t", 1, "c", "int4", "n")]


def test_spread_only_touches_small_inputs(spark):
    small = spark.range(0, 100, 1, 1)
    large = spark.range(0, 100, 1, 8)
    assert spread(small).rdd.getNumPartitions() == 8
    assert spread(large) is large


def test_spread_leaves_inputs_of_many_partitions_on_any_cluster(spark):
    class Cluster:
        """A session of more cores than there are."""

        def __init__(self, cores):
            self.sparkContext = self
            self.defaultParallelism = cores

    class Input:
        isStreaming = False

        def __init__(self, partitions, cores):
            self.sparkSession, self.rdd, self.n = Cluster(cores), self, partitions

        def getNumPartitions(self):
            return self.n

        def repartition(self, cores):
            return cores

    large, small = Input(500, 4000), Input(1, 4000)
    assert spread(large) is large and spread(small) == 4000
