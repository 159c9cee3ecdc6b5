from pyspark.sql import functions as F

from rowharbor.__main__ import arguments, run
from rowharbor.operators.offsets import resume_position
from rowharbor.sinks.dataset import read_change_table, read_rejected


def test_land_follow_and_compare(spark, tmp_path):
    columns, log, root, state, out = (
        str(tmp_path / n) for n in ("columns", "log", "root", "state", "out")
    )
    spark.createDataFrame(
        [("7", "users", 1, "id", "int4")],
        "oid string, relname string, attnum int, attname string, typname string",
    ).write.parquet(columns)
    spark.range(6).selectExpr(
        "1 AS pipeline_id", "concat('0/', id) AS lsn", "current_timestamp() AS commit_ts",
        "concat('Insert(TableId(7), values: [I64(', id, ')])') AS event_text",
    ).write.parquet(log)
    shared = ["--log", log, "--columns", columns, "--root", root]
    run(spark, arguments().parse_args(["land", *shared, "--name", "first"]))
    follow = ["follow", *shared, "--name", "main", "--checkpoints", state, "--once"]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS main_shown LOCATION '{tmp_path / 'db'}'")
    kept = ["--rejects", "--offsets", "default.main_positions", "--max-rows", "4", "--tables", "main_shown"]
    run(spark, arguments().parse_args([*follow, "--max-files", "1", "--compact", *kept]))
    assert resume_position(spark, "main_positions", 1) == "0/5"
    assert read_rejected(spark, root).count() == 0
    assert spark.table("main_shown.USERS_CDC").count() == 12
    spark.sql("DROP DATABASE main_shown CASCADE")
    run(spark, arguments().parse_args(["compact", "--root", root]))
    rows = read_change_table(spark, root, "users")
    ids = rows.select(F.variant_get("payload", "$.id", "int")).collect()
    assert sorted(r[0] for r in ids) == sorted([*range(6), *range(6)])

    row = "(1, 'h', 1, 'u', 'p', 'd', 'pub', 1)"
    names = "id, host, port, username, password, dbname, publication_name, replication_id"
    settings = spark.sql(f"SELECT * FROM VALUES {row} AS t({names})")
    settings.write.parquet(f"{out}/settings")
    both = ["--running", f"{out}/settings", "--desired", f"{out}/settings"]
    run(spark, arguments().parse_args(["actions", *both, "--out", f"{out}/actions"]))
    assert [tuple(r) for r in spark.read.parquet(f"{out}/actions").collect()] == [(1, "keep")]
