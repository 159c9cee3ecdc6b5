"""Initial copies of all tables, and what one reading of a log gives."""

import pytest
from pyspark.sql import functions as F

from helpers import lookup_of
from rowharbor.operators import offsets
from rowharbor.plans import jobs
from rowharbor.sinks import dataset
from rowharbor.streaming import landing
from test_streaming import KEPT, ids, log, write_file


def known_tables(lookup):
    return [(r["oid"], r["table_name"]) for r in lookup.df.collect()]


def read(spark):
    return lambda table: spark.range(3).select("id", F.lit(table).alias("of"))


def test_all_tables_are_copied_and_again_replaces_them(spark, tmp_path):
    lookup, root = lookup_of(spark), str(tmp_path / "root")
    for _ in range(2):
        done = jobs.copy_tables(read(spark), lookup, root, "first")
    tables = known_tables(lookup)
    assert sorted(done) == sorted(oid for oid, _ in tables)
    assert dataset.read_landed(spark, root).count() == 3 * len(tables)


def test_one_table_that_fails_stops_no_other(spark, tmp_path):
    lookup, root = lookup_of(spark), str(tmp_path / "root")
    tables = known_tables(lookup)
    bad = tables[0][1]

    def some(table):
        if table == bad:
            raise OSError("gone")
        return read(spark)(table)

    with pytest.raises(OSError, match="gone"):
        jobs.copy_tables(some, lookup, root, "first")
    others = sum(name != bad for _, name in tables)
    assert dataset.read_landed(spark, root).count() == 3 * others


def test_rejects_and_positions_come_with_the_landing(spark, tmp_path):
    path, root, state = (str(tmp_path / n) for n in ("log", "root", "state"))
    for i in (2, 0, 1):  # files in another order than the log
        write_file(spark, path, 40 * i, 40)
    lookup = lookup_of(spark)
    jobs.follow_log(
        log(spark, path, **landing.flush_limits(max_files=1)),
        lookup,
        root,
        "main",
        state,
        once=True,
        rejects=True,
        offsets="copies_positions",
    ).awaitTermination()
    assert ids(dataset.read_landed(spark, root)) == KEPT
    kept = dataset.read_rejected(spark, root)
    assert kept.count() == 120 - len(KEPT)
    assert kept.select("land_id").distinct().count() == 3
    found = offsets.current_offsets(spark, "copies_positions").select("pipeline_id", "last_lsn")
    # 119 is a control record and is not landed
    assert sorted(tuple(r) for r in found.collect()) == [(0, "0/76"), (1, "0/75")]


def test_a_table_is_read_by_its_own_directories(spark, tmp_path):
    lookup, root = lookup_of(spark), str(tmp_path / "root")
    jobs.copy_tables(read(spark), lookup, root, "first")
    name = known_tables(lookup)[0][1]
    rows = dataset.read_change_table(spark, root, name)
    assert all(f"cdc_table={name.upper()}_CDC" in f for f in rows.inputFiles())
    whole = dataset.read_landed(spark, root).where(F.col("cdc_table") == f"{name.upper()}_CDC")
    assert rows.columns == whole.columns and rows.count() == whole.count()
    assert dataset.read_change_table(spark, root, "never_landed").count() == 0
    assert dataset.read_change_table(spark, root, "od{d").count() == 0
