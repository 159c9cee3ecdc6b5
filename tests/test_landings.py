"""Landings that count, compaction, pieces, the catalog, slices and running settings."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import log_of, lookup_of
from rowharbor.operators import changes, numbering, packing, settings
from rowharbor.plans import jobs
from rowharbor.sinks import dataset, landings as ledger, tables
from rowharbor.sinks.versions import Versions
from rowharbor.sources import spread
from test_plans import exchanges, plan
from test_streaming import KEPT, follow, ids, log, where, write_file  # noqa: F401


def envelopes(spark, first, count):
    texts = [f"Insert(TableId({16384 + i % 3}), values: [I32({i})])" for i in range(first, first + count)]
    return changes.text_envelopes(log_of(spark, texts), lookup_of(spark))


def landed_ids(df):
    first = F.coalesce(F.variant_get("payload", "$.id", "int"), F.variant_get("payload", "$.col_0", "int"))
    return sorted(r[0] for r in df.select(first).collect())


def test_versions_are_published_once(spark, tmp_path):
    one, two = (Versions(spark, str(tmp_path / "v")) for _ in range(2))
    assert one.newest() is None
    assert one.publish(0, {"a": 1}) and not two.publish(0, {"a": 2})
    assert two.newest() == (0, {"a": 1})
    assert two.change(lambda v: {"a": v["a"] + 1}, {"a": 0}) == {"a": 2}
    assert one.numbers() == [0, 1]


def test_many_versions_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "FULL_EVERY", 4)
    root = str(tmp_path)
    for n in range(11):
        ledger.commit(spark, root, {f"l{n}": f"p{n}"}, "main/x", batch=n)
    ledger.commit(spark, root, {"all": "p"}, gone=[f"l{n}" for n in range(10)])
    now = ledger.landings(spark, root)
    assert now.parts == {"l10": "p10", "all": "p"} and now.batches == {"main/x": 10}
    assert len(ledger._versions(spark, root).numbers()) <= 9


def test_compaction_keeps_rows_and_open_readers(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        dataset.land(envelopes(spark, 10 * n, 10), root, f"l{n}")
    before = dataset.read_landed(spark, root)
    new = dataset.compact_landings(spark, root)
    dataset.land(envelopes(spark, 40, 5), root, "later")
    after = dataset.read_landed(spark, root)
    assert landed_ids(before) == list(range(40)) and landed_ids(after) == list(range(45))
    assert {r.land_id for r in after.select("land_id").distinct().collect()} == {new, "later"}
    assert len(dataset.remove_unused(spark, root, keep_hours=1)) == 0
    assert len(dataset.remove_unused(spark, root, keep_hours=0)) == 4
    assert landed_ids(dataset.read_landed(spark, root)) == list(range(45))


def test_a_compaction_that_crashes_changes_nothing(spark, tmp_path, monkeypatch):
    root, whole = str(tmp_path), dataset.commit
    for n in range(2):
        dataset.land(envelopes(spark, 10 * n, 10), root, f"l{n}")
    monkeypatch.setattr(dataset, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        dataset.compact_landings(spark, root)
    monkeypatch.setattr(dataset, "commit", whole)
    assert landed_ids(dataset.read_landed(spark, root)) == list(range(20))
    assert dataset.compact_landings(spark, root) is not None
    assert landed_ids(dataset.read_landed(spark, root)) == list(range(20))
    assert dataset.compact_landings(spark, root) is None


def test_of_two_compactions_one_counts(spark, tmp_path, monkeypatch):
    root, write = str(tmp_path), dataset._write
    for n in range(2):
        dataset.land(envelopes(spark, 10 * n, 10), root, f"l{n}")

    def slow(*args):
        monkeypatch.setattr(dataset, "_write", write)
        dataset.compact_landings(spark, root)
        write(*args)

    monkeypatch.setattr(dataset, "_write", slow)
    with pytest.raises(ledger.Refused, match="gone already"):
        dataset.compact_landings(spark, root)
    assert landed_ids(dataset.read_landed(spark, root)) == list(range(20))


def test_a_record_is_routed_in_one_reading(spark, where):  # noqa: F811
    write_file(spark, where["log"], 0, 120)
    records = spark.read.parquet(where["log"])
    routed = changes.routed_text_changes(records, lookup_of(spark), ["pipeline_id", "lsn"])
    text = plan(routed)
    assert text.count("FileScan") == 1 and "InMemoryTableScan" not in text
    assert exchanges(text) == (0, 1)
    rejected = changes.rejected_changes(records, lookup_of(spark))
    by = lambda df: sorted(map(tuple, df.groupBy("reason").count().collect()))
    assert by(routed.where("reason IS NOT NULL")) == by(rejected)
    assert ids(routed.where("reason IS NULL")) == KEPT


def test_typed_records_are_routed_too(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES (1, 16384L, 'insert', array(CAST(1 AS variant))),
        (2, 16384L, 'begin', NULL), (3, 16384L, 'truncate', array()), (4, 99L, 'update', array()),
        (5, 16384L, 'delete', NULL) AS t(n, table_oid, kind, cells)"""
    ).withColumns({"commit_ts": F.lit("2024-01-01").cast("timestamp"), "lsn": F.lit("0/1")})
    routed = changes.routed_typed_changes(rows, lookup_of(spark), ["n"])
    got = {r.n: (r.cdc_table, r.reason, r.p) for r in routed.withColumn("p", F.to_json("payload")).collect()}
    assert got == {
        1: ("USERS_CDC", None, '{"id":1}'),
        2: ("rejected", "control", None),
        3: ("rejected", "no operation", None),
        4: ("rejected", "no table", None),
        5: ("rejected", "bad cells", None),
    }
    known = changes.rejected_typed_changes(rows, lookup_of(spark))
    assert {r.n: r.reason for r in known.collect()} == {n: v[1] for n, v in got.items() if v[1]}


@pytest.mark.parametrize("most", [1, 7, 40, 1000])
def test_pieces_hold_so_many_records(spark, where, most):  # noqa: F811
    for first in (0, 60):
        write_file(spark, where["log"], first, 60)
    records = spark.read.parquet(where["log"])
    jobs.land_log(records, lookup_of(spark), where["root"], "all", rejects=True, most_rows=most)
    stored = dataset.read_stored(spark, where["root"])
    sizes = [r["count"] for r in stored.groupBy("piece").count().orderBy("piece").collect()]
    assert sizes == [most] * (120 // most) + [120 % most] * (120 % most > 0)
    assert ids(dataset.read_landed(spark, where["root"])) == KEPT


def test_pieces_share_files(spark, where, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(spread, "TASK_ROWS", 100)
    write_file(spark, where["log"], 0, 600)
    records = spark.read.parquet(where["log"])
    jobs.land_log(records, lookup_of(spark), where["root"], "all", rejects=True, most_rows=5)
    stored = dataset.read_stored(spark, where["root"]).withColumn("file", F.input_file_name())
    sizes = [tuple(r) for r in stored.groupBy("piece").count().orderBy("piece").collect()]
    assert sizes == [(n, 5) for n in range(120)]
    # files come from tasks and tables, not from pieces; a piece is written by one task
    assert stored.select("file").distinct().count() <= 8 * 4
    by_table = stored.groupBy("piece", "cdc_table").agg(F.count_distinct("file").alias("n"))
    assert {r["n"] for r in by_table.collect()} == {1}
    database = "shown_pieces"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path / 'db'}'")
    tables.register_landings(spark, where["root"], database)
    in_catalog = spark.table(f"{database}.USERS_CDC").count()
    spark.sql(f"DROP DATABASE {database} CASCADE")
    assert in_catalog == stored.where("cdc_table = 'USERS_CDC'").count()


def test_pieces_in_directories_of_their_own_are_still_read(spark, tmp_path):
    root = str(tmp_path)
    rows = dataset.change_rows(envelopes(spark, 0, 30))
    rows.withColumn("piece", F.lit(7).cast("long")).write.partitionBy(
        "piece", "cdc_table"
    ).parquet(f"{root}/land_id=old/part=p")
    ledger.commit(spark, root, {"old": "p"})
    dataset.land(envelopes(spark, 30, 10).withColumn("piece", F.lit(2).cast("long")), root, "new")
    stored = dataset.read_stored(spark, root)
    assert {tuple(r) for r in stored.groupBy("land_id", "piece").count().collect()} == {("old", 7, 30), ("new", 2, 10)}
    assert landed_ids(dataset.read_landed(spark, root)) == list(range(40))


def test_landings_are_shown_all_or_none(spark, tmp_path, monkeypatch):
    root, database = str(tmp_path / "root"), "shown_landings"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path / 'db'}'")
    count = lambda name: spark.table(f"{database}.{name}_CDC").count()
    dataset.land(envelopes(spark, 0, 30), root, "it's one")
    tables.register_landings(spark, root, database)
    tables.register_landings(spark, root, database)
    assert [count(n) for n in ("USERS", "TWINS", "BARE")] == [10, 10, 10]
    dataset.land(envelopes(spark, 30, 30), root, "two")
    whole, done = tables._register, []

    def crash(*args):
        whole(*args)
        raise RuntimeError("before the change")

    monkeypatch.setattr(tables, "_register", crash)
    with pytest.raises(RuntimeError):
        tables.register_landings(spark, root, database)
    assert [count(n) for n in ("USERS", "TWINS", "BARE")] == [10, 10, 10]
    monkeypatch.setattr(tables, "_register", whole)
    tables.register_landings(spark, root, database)
    assert [count(n) for n in ("USERS", "TWINS", "BARE")] == [20, 20, 20]
    dataset.compact_landings(spark, root)
    assert count("USERS") == 20
    tables.register_landings(spark, root, database)
    dataset.remove_unused(spark, root, keep_hours=0)
    assert [count(n) for n in ("USERS", "TWINS", "BARE")] == [20, 20, 20]
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_copy_in_slices_goes_on(spark, tmp_path, monkeypatch):
    root, lookup, whole, done = str(tmp_path), lookup_of(spark), jobs.land, []
    # a third of all rows have one key, some have none
    rows = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN 7L WHEN id % 50 = 1 THEN NULL ELSE id END AS id", "id AS n")

    def land(*args, **named):
        if len(done) == 2:
            raise OSError("gone")
        done.append(whole(*args, **named))

    monkeypatch.setattr(jobs, "land", land)
    with pytest.raises(OSError, match="gone"):
        jobs.copy_slices(rows, lookup, "16384", root, "first", "id", 6)
    part = dataset.read_landed(spark, root).count()
    assert 0 < part < 300
    monkeypatch.setattr(jobs, "land", whole)
    dataset.compact_landings(spark, root)
    left = jobs.copy_slices(rows, lookup, "16384", root, "first", "id", 6)
    assert 1 <= left <= 4 and jobs.copy_slices(rows, lookup, "16384", root, "first", "id", 6) == 0
    found = dataset.read_landed(spark, root).select(F.variant_get("payload", "$.n", "long"))
    assert sorted(r[0] for r in found.collect()) == list(range(300))


def test_an_empty_table_is_copied_in_one_slice(spark, tmp_path):
    rows = spark.range(0).selectExpr("id")
    assert jobs.copy_slices(rows, lookup_of(spark), "16384", str(tmp_path), "first", "id", 4) == 1


def test_tables_of_one_name_in_two_schemas_are_both_copied(spark, tmp_path):
    from rowharbor.operators.catalog import table_columns, table_lookup
    from rowharbor.operators.lookup import measured

    columns = spark.createDataFrame(
        [("1", "t", 1, "id", "int8", "a"), ("2", "t", 1, "id", "int8", 'b"c')],
        "oid string, relname string, attnum int, attname string, typname string, nspname string",
    )
    lookup, read = measured(table_lookup(table_columns(columns))), []

    def rows(name):
        read.append(name)
        return spark.range(2)

    jobs.copy_tables(rows, lookup, str(tmp_path), "first", at_once=1)
    assert read == ['"a"."t"', '"b""c"."t"']


def test_actions_are_said_against_what_runs(spark, tmp_path):
    def version(*rows):
        schema = ", ".join(f"{c} {'int' if c in ('id', 'port') else 'string'}" for c in settings.SETTINGS)
        return spark.createDataFrame([(i, h, 1, "u", "p", "d", "pub", "1") for i, h in rows], schema)

    running = settings.RunningSet(spark, str(tmp_path))
    actions = lambda v: {r.id: r.action for r in running.poll(v).collect()}
    first = version((1, "a"), (2, "a"), (3, "a"))
    assert actions(first) == {1: "start", 2: "start", 3: "start"}
    running.took(first, running.poll(first))
    second = version((1, "a"), (2, "b"), (4, "a"))
    want = {1: "keep", 2: "restart", 3: "stop", 4: "start"}
    assert actions(second) == want
    running.took(second, running.poll(second).where("id IN (1, 3)"))
    assert actions(second) == {1: "keep", 2: "restart", 4: "start"}
    running.took(second, running.poll(second))
    assert actions(second) == {1: "keep", 2: "keep", 4: "keep"}
    assert actions(first) == {1: "keep", 2: "restart", 3: "start", 4: "stop"}


def test_batches_by_rows_and_bytes(spark):
    sizes = [5, 400, 5, 5, 90, 3, 3, 3, 3, 3, 250, 40, 40, 40, 40] * 8
    texts = [f"Insert(TableId(16384), values: [String(\"{'x' * n}\")])" for n in sizes]
    rows = changes.text_envelopes(log_of(spark, texts), lookup_of(spark), keep=["n"])
    overhead = len(packing.measured_batches(rows.where("n = 0"), ["n"]).first()["batch_json"]) - 5 - 2
    most = 3 * overhead + 300
    batches = packing.measured_batches(rows, ["n"], batch_rows=4, batch_bytes=most).orderBy("batch").collect()
    assert [b["batch"] for b in batches] == list(range(len(batches)))
    assert all(b["n_rows"] <= 4 and (b["n_bytes"] <= most or b["n_rows"] == 1) for b in batches)
    got = [len(str(list(e["payload"].values())[0])) for b in batches for e in json.loads(b["batch_json"])]
    assert got == sizes
    assert packing.measured_batches(rows.where("n < 0"), ["n"]).count() == 0


def test_numbers_are_consecutive_in_groups_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(numbering, "BROADCAST_ROWS", 0)
    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 40)) AS k", "id DIV 5 AS at", "id")
    found = numbering.consecutive(rows, ["k"], ["at", "id"]).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r.k, r.number)):
        by.setdefault(r.k, []).append((r.number, r.id))
    assert all([n for n, _ in v] == list(range(len(v))) for v in by.values())
    assert all([i for _, i in v] == sorted(i for _, i in v) for v in by.values()) and len(found) == 3000


def test_compacted_files_are_in_log_order(spark, tmp_path):
    root = str(tmp_path)
    rows = envelopes(spark, 0, 3000)
    place = F.struct(
        F.lit("2024-01-01").cast("timestamp").alias("at"),
        F.lit("f").alias("file"),
        F.lit(0).cast("long").alias("block"),
        F.pmod(F.xxhash64(F.to_json("payload")), F.lit(1 << 40)).alias("row"),
    )
    for n in range(3):
        dataset.land(rows.withColumn("position", place), root, f"l{n}")
    dataset.compact_landings(spark, root)
    files = dataset.read_landed(spark, root).inputFiles()
    assert len(files) == 3
    for file in files:
        found = [r[0] for r in spark.read.parquet(file).select("position.row").collect()]
        assert len(found) == 3000 and found == sorted(found)


def test_a_compaction_deals_a_table_to_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dataset, "TASK_ROWS", 50, raising=False)
    root = str(tmp_path)
    number = F.variant_get("payload", "$.id", "long")
    place = F.struct(
        F.lit("2024-01-01").cast("timestamp").alias("at"),
        F.lit("f").alias("file"),
        F.lit(0).cast("long").alias("block"),
        number.alias("row"),
    )
    for n in range(3):
        users = envelopes(spark, 600 * n, 600).where("cdc_table = 'USERS_CDC'")
        # a copy's rows have no position
        dataset.land(users if n == 0 else users.withColumn("position", place), root, f"l{n}")
    want = landed_ids(dataset.read_landed(spark, root))
    dataset.compact_landings(spark, root)
    rows = dataset.read_landed(spark, root)
    assert landed_ids(rows) == want and len(want) == 600
    files = rows.groupBy(F.input_file_name()).agg(
        F.count("*").alias("n"),
        F.count("position").alias("m"),
        F.min("position.row").alias("low"),
        F.max("position.row").alias("high"),
    ).collect()
    assert len(files) >= 10 and max(f.n for f in files) < 2 * 50
    ranges = sorted((f.low, f.high) for f in files if f.m)
    assert all(before[1] < after[0] for before, after in zip(ranges, ranges[1:]))


def test_wide_rows_are_compacted_by_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dataset, "TASK_BYTES", 2000, raising=False)
    root = str(tmp_path)
    for n in range(2):
        dataset.land(envelopes(spark, 300 * n, 300).where("cdc_table = 'USERS_CDC'"), root, f"l{n}")
    dataset.compact_landings(spark, root)
    rows = dataset.read_landed(spark, root)
    assert len(rows.inputFiles()) > 2 and rows.count() == 200
