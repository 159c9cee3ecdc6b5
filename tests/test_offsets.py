from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from rowharbor.functions.lsn import lsn_number
from rowharbor.operators import offsets
from rowharbor.sinks.versions import Versions


def table(spark, *rows):
    return spark.createDataFrame(
        list(rows), "pipeline_id int, last_lsn string"
    ).withColumn("updated_at", F.lit("2024-01-01").cast("timestamp_ntz"))


def test_lsn_order_is_numeric(spark):
    lsns = ["0/9", "0/10", "9/0", "10/0", "FFFFFFFF/FFFFFFFF", "12", "x", None]
    rows = spark.createDataFrame([(s,) for s in lsns], "s string")
    got = [r[0] for r in rows.select(lsn_number(F.col("s"))).collect()]
    assert got == [9, 16, 9 * 2**32, 16 * 2**32, 2**64 - 1, 12, None, None]


def test_latest_positions(spark):
    log = spark.createDataFrame(
        [(1, "0/9"), (1, "0/10"), (2, "A/0"), (2, "9/FFFF"), (3, "16/0000B374"),
         (3, "16/0000B2FF"), (4, "99"), (4, "0100"), (5, None), (5, "x"),
         (6, "FFFFFFFF/FFFFFFFF"), (6, None)],
        "pipeline_id int, lsn string",
    )
    got = {tuple(r) for r in offsets.latest_positions(log).collect()}
    assert got == {
        (1, "0/10"),
        (2, "A/0"),
        (3, "16/0000B374"),
        (4, "0100"),
        (5, None),
        (6, "FFFFFFFF/FFFFFFFF"),
    }


def test_upsert(spark):
    target = table(spark, (1, "0/1"), (2, "0/2"), (90, None))
    source = spark.createDataFrame(
        [(2, "0/9"), (3, "0/3")], "pipeline_id int, last_lsn string"
    )
    merged = offsets.merged_offsets(target, source, F.lit("2025-05-05").cast("timestamp_ntz"))
    got = {r["pipeline_id"]: (r["last_lsn"], r["updated_at"].year) for r in merged.collect()}
    assert got == {
        1: ("0/1", 2024),
        2: ("0/9", 2025),
        3: ("0/3", 2025),
        90: (None, 2024),
    }
    assert offsets.last_offset(merged, 2).first()[0] == "0/9"
    assert offsets.last_offset(merged, 90).first()[0] is None
    assert offsets.last_offset(merged, 7).first() is None


def test_table_versions(spark):
    name = "offsets_of_pipelines"
    first = spark.createDataFrame([(1, "0/1"), (2, "0/2")], "pipeline_id int, last_lsn string")
    second = spark.createDataFrame([(2, "0/5"), (3, "0/3")], "pipeline_id int, last_lsn string")
    assert offsets.resume_position(spark, name, 2) is None
    assert offsets.current_offsets(spark, name).count() == 0
    offsets.update_offsets(spark, name, first)
    offsets.update_offsets(spark, name, second)
    current = offsets.current_offsets(spark, name)
    got = {r["pipeline_id"]: r["last_lsn"] for r in current.collect()}
    assert got == {1: "0/1", 2: "0/5", 3: "0/3"}
    assert offsets.resume_position(spark, name, 2) == "0/5"
    assert offsets.resume_position(spark, name, 9) is None
    offsets.update_offsets(spark, name, second)
    assert offsets.current_offsets(spark, name).count() == 3
    versions = spark.table(name).select("version").distinct().collect()
    assert len(versions) == 2
    spark.sql(f"DROP TABLE {name}")


def test_no_update_is_lost_to_another_writer(spark, monkeypatch):
    name = "offsets_of_two_writers"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    given = lambda i, lsn: spark.createDataFrame([(i, lsn)], "pipeline_id int, last_lsn string")
    offsets.update_offsets(spark, name, given(0, "0/0"))
    publish, between = Versions.publish, [lambda: offsets.update_offsets(spark, name, given(2, "0/2"))]

    def slow(self, number, value):
        if between:  # another writer comes between the reading and the publishing
            between.pop()()
        return publish(self, number, value)

    monkeypatch.setattr(Versions, "publish", slow)
    offsets.update_offsets(spark, name, given(1, "0/1"))
    found = offsets.current_offsets(spark, name).select("pipeline_id", "last_lsn").collect()
    assert sorted(map(tuple, found)) == [(0, "0/0"), (1, "0/1"), (2, "0/2")]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: offsets.update_offsets(spark, name, given(i, f"1/{i}")), range(3, 9)))
    assert offsets.current_offsets(spark, name).count() == 9
    spark.sql(f"DROP TABLE {name}")


def test_positions_keep_the_text_they_were_given(spark):
    rows = [(1, "0/b4"), (1, "0/B3"), (2, "aB/0000cD"), (2, "aB/0000cC"), (3, "0/00a"), (3, "0/A"), (4, "16")]
    log = spark.createDataFrame(rows, "pipeline_id int, lsn string")
    got = dict(tuple(r) for r in offsets.latest_positions(log).collect())
    assert got == {1: "0/b4", 2: "aB/0000cD", 3: "0/00a", 4: "16"}


def test_what_is_no_lsn_has_no_number(spark):
    lsns = ["zz/qq", "1/2/3", "12 ", "0/1FFFFFFFFF", "", "-1", "0/1a2b"]
    rows = spark.createDataFrame([(s,) for s in lsns], "s string")
    got = [r[0] for r in rows.select(lsn_number(F.col("s"))).collect()]
    assert got[:-1] == [None] * 6 and int(got[-1]) == 0x1A2B
