import json
import shutil
import time
from pathlib import Path
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import lookup_of, payloads
from rowharbor.operators import changes
from rowharbor.plans import jobs
from rowharbor.sinks import dataset
from rowharbor.sinks.landings import Refused, landings
from rowharbor.sources import change_log, spread
from rowharbor.streaming import landing
from workload import inputs


def write_file(spark, path, first, count, mode="append"):
    """One Parquet file of change records."""
    spark.range(first, first + count, 1, 1).selectExpr(
        "CAST(id % 2 AS int) AS pipeline_id",
        "concat('0/', hex(id)) AS lsn",
        "TIMESTAMP '2024-01-01 00:00:00' AS commit_ts",
        """concat(CASE id % 4 WHEN 0 THEN 'Insert' WHEN 1 THEN 'Update'
            WHEN 2 THEN 'Delete' ELSE 'Begin' END, '(TableId(',
            CAST(16384 + id % 3 AS string), '), values: [I64(',
            CAST(id AS string), ')])') AS event_text""",
    ).write.mode(mode).parquet(path)


def ids(df, payload="payload"):
    first = F.coalesce(
        F.variant_get(payload, "$.id", "long"), F.variant_get(payload, "$.col_0", "long")
    )
    return sorted(r[0] for r in df.select(first).collect())


def log(spark, path, **options):
    return change_log.read_text_log(spark, path, streaming=True, options=options)


KEPT = [i for i in range(120) if i % 4 != 3]


@pytest.fixture
def where(tmp_path):
    return {name: str(tmp_path / name) for name in ("log", "root", "state", "other")}


def follow(spark, where, lookup, **options):
    query = jobs.follow_log(
        log(spark, where["log"], **options),
        lookup,
        where["root"],
        "main",
        where["state"],
        once=True,
    )
    query.awaitTermination()
    return query


def test_stream_lands_what_a_batch_lands(spark, where):
    for i in range(3):
        write_file(spark, where["log"], 40 * i, 40)
    lookup = lookup_of(spark)
    query = follow(spark, where, lookup, **landing.flush_limits(max_files=1))
    batch = change_log.read_text_log(spark, where["log"])
    jobs.land_log(batch, lookup, where["other"], "all")
    streamed = dataset.read_landed(spark, where["root"])
    landed = dataset.read_landed(spark, where["other"])
    by = ["cdc_table", "operation", "ts_ms", "pipeline_id", "lsn"]
    rows = lambda df: sorted(
        tuple(r) for r in df.select(*by, F.to_json("payload")).collect()
    )
    assert rows(streamed) == rows(landed) and ids(streamed) == KEPT
    assert streamed.select("land_id").distinct().count() == 3
    assert query.lastProgress["batchId"] == 2


def test_goes_on_from_the_checkpoint(spark, where):
    lookup = lookup_of(spark)
    write_file(spark, where["log"], 0, 60)
    follow(spark, where, lookup)
    follow(spark, where, lookup)
    write_file(spark, where["log"], 60, 60)
    follow(spark, where, lookup)
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT


def test_a_failed_batch_is_done_again_without_loss_or_double(spark, where, monkeypatch):
    for i in range(3):
        write_file(spark, where["log"], 40 * i, 40)
    lookup, whole, failed = lookup_of(spark), jobs.land, []

    def land(rows, root, land_id, *rest):
        whole(rows, root, land_id, *rest)
        if land_id.endswith("1") and not failed:
            failed.append(land_id)
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(jobs, "land", land)
    limits = landing.flush_limits(max_files=1)
    with pytest.raises(Exception, match="lost after the write"):
        follow(spark, where, lookup, **limits)
    assert ids(dataset.read_landed(spark, where["root"])) != KEPT
    follow(spark, where, lookup, **limits)
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT
    assert len(landings(spark, where["root"]).parts) == 3


def test_a_batch_that_fails_before_it_counts_is_written_again(spark, where, monkeypatch):
    write_file(spark, where["log"], 0, 120)
    lookup, whole = lookup_of(spark), dataset.commit
    monkeypatch.setattr(dataset, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        follow(spark, where, lookup)
    assert dataset.read_landed(spark, where["root"]).count() == 0
    monkeypatch.setattr(dataset, "commit", whole)
    follow(spark, where, lookup)
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT
    left = dataset.remove_unused(spark, where["root"], keep_hours=0)
    assert len(left) == 1 and ids(dataset.read_landed(spark, where["root"])) == KEPT


def test_a_quiet_tail_is_flushed(spark, where):
    write_file(spark, where["log"], 0, 20)
    query = jobs.follow_log(
        log(spark, where["log"]), lookup_of(spark), where["root"], "main", where["state"]
    )
    try:
        query.processAllAvailable()
        write_file(spark, where["log"], 20, 1)
        deadline = time.time() + 60
        while time.time() < deadline:
            if 20 in ids(dataset.read_landed(spark, where["root"])):
                break
            time.sleep(0.5)
        else:
            pytest.fail("the last record did not land")
    finally:
        query.stop()


def test_two_streams_and_a_snapshot_share_a_dataset(spark, where):
    lookup = lookup_of(spark)
    write_file(spark, where["log"], 0, 20)
    rows = spark.createDataFrame([(1000, "x")], "id int, name string")
    jobs.copy_table(rows, lookup, "16384", where["root"], "snapshot-users")
    for stream in ("a", "b"):
        jobs.follow_log(
            log(spark, where["log"]), lookup, where["root"], stream, where["state"],
            once=True,
        ).awaitTermination()
    kept = [i for i in KEPT if i < 20]
    assert ids(dataset.read_landed(spark, where["root"])) == sorted(kept + kept + [1000])


def test_spark_file_sink(spark, where):
    lookup = lookup_of(spark)
    for first in (0, 60):
        write_file(spark, where["log"], first, 60)
        rows = changes.text_envelopes(log(spark, where["log"]), lookup, jobs.POSITION)
        landing.start_file_sink(
            rows, where["root"], where["state"], once=True
        ).awaitTermination()
    assert ids(spark.read.parquet(where["root"])) == KEPT


def test_rejected_records_are_kept(spark, where):
    write_file(spark, where["log"], 0, 40)
    jobs.follow_rejects(
        log(spark, where["log"]), lookup_of(spark), where["other"], where["state"],
        once=True,
    ).awaitTermination()
    kept = spark.read.parquet(where["other"])
    assert {r["reason"] for r in kept.collect()} == {"control"}
    assert kept.count() == 10


def test_positions_follow_the_landing(spark, where):
    write_file(spark, where["log"], 0, 40)
    follow(spark, where, lookup_of(spark))
    spark.sql("DROP TABLE IF EXISTS stream_offsets")
    landed = dataset.read_landed(spark, where["root"])
    jobs.record_positions(spark, landed, "stream_offsets")
    from rowharbor.operators.offsets import current_offsets

    got = {
        r["pipeline_id"]: r["last_lsn"]
        for r in current_offsets(spark, "stream_offsets").collect()
    }
    assert got == {0: "0/26", 1: "0/25"}
    spark.sql("DROP TABLE stream_offsets")


def test_json_log_with_typed_cells(spark, where):
    lines = [
        '{"pipeline_id":1,"lsn":"0/1","commit_ts":"2024-01-01T00:00:00Z",'
        '"table_oid":16384,"kind":"insert","cells":[7,"a, ] b"]}',
        '{"pipeline_id":1,"lsn":"0/2","commit_ts":"2024-01-01T00:00:00Z",'
        '"table_oid":16384,"kind":"update","cells":[8,null]}',
        '{"pipeline_id":1,"lsn":"0/3","commit_ts":"2024-01-01T00:00:00Z",'
        '"table_oid":16384,"kind":"update","cells":"not an array"}',
    ]
    spark.createDataFrame([(s,) for s in lines], "value string").coalesce(1).write.text(
        where["log"]
    )
    records = change_log.read_typed_log(spark, where["log"], "json")
    bad = records.filter("bad_cells IS NOT NULL").collect()
    assert [(r["lsn"], r["bad_cells"]) for r in bad] == [("0/3", "not an array")]
    rows = changes.typed_envelopes(records, lookup_of(spark), keep=["lsn"])
    assert payloads(rows, "lsn") == {
        "0/1": {"id": 7, "name": "a, ] b"},
        "0/2": {"id": 8, "name": None},
    }
    stream = change_log.read_typed_log(spark, where["log"], "json", streaming=True)
    jobs.follow_rejects(
        stream, lookup_of(spark), where["other"], where["state"], once=True
    ).awaitTermination()
    kept = spark.read.parquet(where["other"]).collect()
    assert [(r["lsn"], r["reason"], r["bad_cells"]) for r in kept] == [
        ("0/3", "bad cells", "not an array")
    ]


def test_broken_json_keeps_its_text(spark, where):
    good = '{"pipeline_id":1,"lsn":"0/1","event_text":"Insert(TableId(16384), values: [I32(1)])"}'
    broken = '{"pipeline_id":1,"lsn":"0/2","event_te'
    spark.createDataFrame([(good,), (broken,)], "value string").coalesce(1).write.text(where["log"])
    records = change_log.read_text_log(spark, where["log"], "json")
    assert payloads(changes.text_envelopes(records, lookup_of(spark), keep=["lsn"]), "lsn") == {"0/1": {"id": 1}}
    stream = change_log.read_text_log(spark, where["log"], "json", streaming=True)
    jobs.follow_rejects(
        stream, lookup_of(spark), where["other"], where["state"], once=True
    ).awaitTermination()
    kept = spark.read.parquet(where["other"]).collect()
    assert [(r["reason"], r["bad_record"]) for r in kept] == [("bad record", broken)]


def test_plain_text_log(spark, where):
    texts = [("Insert(TableId(16384), values: [I32(1)])",), ("Begin(x)",)]
    spark.createDataFrame(texts, "value string").write.text(where["log"])
    records = change_log.read_text_log(spark, where["log"], "text")
    rows = changes.text_envelopes(records, lookup_of(spark), keep=["lsn"])
    got = rows.select("cdc_table", "ts_ms", F.to_json("payload")).collect()
    assert [(r[0], r[2]) for r in got] == [("USERS_CDC", '{"id":1}')]
    assert abs(got[0][1] / 1000 - time.time()) < 600


def checkpoint(where):
    return Path(where["state"]) / "main"


@pytest.mark.parametrize("lost", ["deleted", "elsewhere"])
def test_a_stream_without_its_checkpoint_goes_on(spark, where, tmp_path, lost):
    lookup = lookup_of(spark)
    write_file(spark, where["log"], 0, 60)
    follow(spark, where, lookup)
    if lost == "deleted":
        shutil.rmtree(checkpoint(where))
    else:
        where = where | {"state": str(tmp_path / "another")}
    write_file(spark, where["log"], 60, 30)
    follow(spark, where, lookup)
    assert ids(dataset.read_landed(spark, where["root"])) == [i for i in KEPT if i < 90]
    # and goes on from the new one
    write_file(spark, where["log"], 90, 30)
    follow(spark, where, lookup)
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT


def test_a_checkpoint_that_is_moved_goes_on(spark, where, tmp_path):
    lookup = lookup_of(spark)
    write_file(spark, where["log"], 0, 60)
    follow(spark, where, lookup)
    shutil.move(where["state"], tmp_path / "moved")
    where = where | {"state": str(tmp_path / "moved")}
    write_file(spark, where["log"], 60, 60)
    follow(spark, where, lookup)
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT
    assert len(landings(spark, where["root"]).batches) == 1


def test_an_older_copy_of_a_checkpoint_goes_on(spark, where, tmp_path):
    lookup, limits = lookup_of(spark), landing.flush_limits(max_files=1)
    write_file(spark, where["log"], 0, 30)
    follow(spark, where, lookup, **limits)
    shutil.copytree(checkpoint(where), tmp_path / "copy")
    for first in (30, 60):
        write_file(spark, where["log"], first, 30)
        follow(spark, where, lookup, **limits)
    shutil.rmtree(checkpoint(where))
    shutil.copytree(tmp_path / "copy", checkpoint(where))
    write_file(spark, where["log"], 90, 30)
    follow(spark, where, lookup)  # other batches than before
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT
    follow(spark, where, lookup)
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT


def test_a_lost_checkpoint_after_compaction(spark, where):
    lookup, limits = lookup_of(spark), landing.flush_limits(max_files=1)
    for first in (0, 30, 60):
        write_file(spark, where["log"], first, 30)
    follow(spark, where, lookup, **limits)
    dataset.compact_landings(spark, where["root"])
    shutil.rmtree(checkpoint(where))
    write_file(spark, where["log"], 90, 30)
    follow(spark, where, lookup)
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT


def test_a_dataset_behind_its_checkpoint_is_refused(spark, where, tmp_path):
    lookup = lookup_of(spark)
    write_file(spark, where["log"], 0, 60)
    follow(spark, where, lookup)
    with pytest.raises(Refused, match="lacks batches 0 to 0"):
        follow(spark, where | {"root": str(tmp_path / "empty")}, lookup)


def test_a_log_without_positions_cannot_go_on_without_its_checkpoint(spark, where):
    lookup = lookup_of(spark)
    write_file(spark, where["log"], 0, 60)

    def run():
        bare = log(spark, where["log"]).drop("position")
        jobs.follow_log(bare, lookup, where["root"], "main", where["state"], once=True).awaitTermination()

    run()
    run()
    shutil.rmtree(checkpoint(where))
    with pytest.raises(Refused, match="no position"):
        run()
    assert ids(dataset.read_landed(spark, where["root"])) == [i for i in KEPT if i < 60]


def test_a_landing_of_another_is_refused(spark, where):
    lookup = lookup_of(spark)
    write_file(spark, where["log"], 0, 60)
    follow(spark, where, lookup)
    taken = next(iter(landings(spark, where["root"]).parts))
    with pytest.raises(Refused, match="another owner"):
        jobs.land_log(change_log.read_text_log(spark, where["log"]), lookup, where["root"], taken)
    assert ids(dataset.read_landed(spark, where["root"])) == [i for i in KEPT if i < 60]


@pytest.mark.parametrize("file_format", ["json", "text"])
def test_positions_of_line_logs_follow_the_lines(spark, where, file_format):
    def line(i):
        text = f"Insert(TableId(16384), values: [I32({i})]){' ' * (i % 50)}"
        return json.dumps({"pipeline_id": 1, "lsn": "0/1", "event_text": text}) if file_format == "json" else text

    for name in ("a", "b"):
        first = 0 if name == "a" else 5000
        lines = spark.createDataFrame([(line(first + i),) for i in range(5000)], "value string")
        lines.coalesce(1).write.mode("append").text(where["log"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        records = change_log.read_text_log(spark, where["log"], file_format)
        assert records.rdd.getNumPartitions() > 4
        jobs.land_log(records, lookup_of(spark), where["root"], "all")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = dataset.in_log_order(dataset.read_landed(spark, where["root"]))
    assert [r[0] for r in rows.select(F.variant_get("payload", "$.id", "int")).collect()] == list(range(10000))


def test_a_file_of_one_row_group_is_landed_by_tasks_of_bounded_size(spark, where, monkeypatch):
    monkeypatch.setattr(spread, "TASK_ROWS", 500)
    write_file(spark, where["log"], 0, 10_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:  # many slices, one of which has all records
        assert spark.read.parquet(where["log"]).rdd.getNumPartitions() > spread.MOST_MOVED
        follow(spark, where, lookup_of(spark))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    landed = dataset.read_landed(spark, where["root"])
    sizes = [r["count"] for r in landed.groupBy(F.input_file_name(), "cdc_table").count().collect()]
    assert ids(landed) == [i for i in range(10_000) if i % 4 != 3] and max(sizes) < 2 * spread.TASK_ROWS
    rows = dataset.in_log_order(landed.where("cdc_table = 'USERS_CDC'"))
    order = [r[0] for r in rows.select(F.variant_get("payload", "$.id", "int")).collect()]
    assert order == [i for i in range(10_000) if i % 4 != 3 and i % 3 == 0]


def test_a_stream_writes_variants_whole_and_a_compaction_takes_them_apart(spark, where):
    def apart():
        files = dataset.read_landed(spark, where["root"]).inputFiles()
        return {"typed_value" in str(pq.read_schema(urlparse(file).path).field("payload").type) for file in files}

    for i in range(2):
        write_file(spark, where["log"], 60 * i, 60)
    setting = spark.conf.get(jobs.SHREDDING)
    follow(spark, where, lookup_of(spark), **landing.flush_limits(max_files=1))
    assert apart() == {False} and spark.conf.get(jobs.SHREDDING) == setting
    dataset.compact_landings(spark, where["root"])
    assert apart() == {setting == "true"} and ids(dataset.read_landed(spark, where["root"])) == KEPT


def test_the_log_of_the_workload_is_written_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "FILE_ROWS", 400)
    events = spark.range(0, 6000, 1, 3).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "id % 7 AS user_id",
        "'signup' AS event_type", "CAST(id AS double) AS value", "'{}' AS props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    inputs.log_in_files(spark, str(tmp_path), str(tmp_path / "log"))
    written = spark.read.parquet(str(tmp_path / "log")).withColumn("file", F.input_file_name())
    files = written.groupBy("file").agg(F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id"))
    found = [tuple(r)[1:] for r in files.orderBy("low").collect()]
    assert sum(n for n, _, _ in found) == 6000 and max(n for n, _, _ in found) <= 800 and len(found) >= 9
    assert all(n == high - low + 1 for n, low, high in found)
