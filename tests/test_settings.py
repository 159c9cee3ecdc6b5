from decimal import Decimal

from pyspark.sql import functions as F

from rowharbor.operators import settings
from rowharbor.sources.database import postgres_options

SCHEMA = (
    "id int, host string, port int, username string, password string, dbname string, "
    "publication_name string, replication_id long"
)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def row(id, host="h", port=5432, password="x", replication_id=1):
    return (id, host, port, "u", password, "db", "pub", replication_id)


def test_narrowing(spark):
    stored = rows(
        spark,
        row(1, port=70000, replication_id=-1),
        row(2, port=-1, replication_id=7),
        row(3, port=65535, replication_id=-(2**63)),
    )
    got = {
        r["id"]: (r["port"], r["replication_id"])
        for r in settings.pipeline_settings(stored).collect()
    }
    assert got == {
        1: (4464, Decimal(2**64 - 1)),
        2: (65535, Decimal(7)),
        3: (65535, Decimal(2**63)),
    }


def test_actions(spark):
    running = rows(spark, row(1), row(2), row(3), row(4, password=None), row(5, None))
    desired = rows(
        spark, row(2), row(3, port=1), row(4, password=None), row(5, "h"), row(6)
    )
    got = {r["id"]: r["action"] for r in settings.pipeline_actions(running, desired).collect()}
    assert got == {
        1: "stop",
        2: "keep",
        3: "restart",
        4: "keep",
        5: "restart",
        6: "start",
    }
    assert [r["id"] for r in settings.stopped_ids(running, desired).collect()] == [1]


def test_nothing_runs_at_first(spark):
    none = rows(spark, row(1)).filter(F.lit(False))
    got = settings.pipeline_actions(none, rows(spark, row(1))).collect()
    assert [(r["id"], r["action"]) for r in got] == [(1, "start")]
    assert settings.pipeline_actions(none, none).count() == 0


def test_settings_table(spark):
    settings.create_settings_table(spark, "settings_source")
    settings.create_settings_table(spark, "settings_source")
    spark.sql(
        f"INSERT INTO settings_source ({', '.join(settings.SETTINGS)}) "
        "VALUES (1, 'h', 5432, 'u', 'x', 'db', 'pub', 3)"
    )
    assert spark.table("settings_source").filter("created_at IS NULL").count() == 0
    got = settings.pipeline_settings(spark.table("settings_source"))
    assert got.columns == list(settings.SETTINGS)
    assert settings.pipeline_ids(got).first()[0] == 1
    spark.sql("DROP TABLE settings_source")


def test_postgres_options():
    got = postgres_options(
        {"host": "db", "port": 5433, "username": "u", "password": "p", "dbname": "app"}
    )
    assert got["url"] == "jdbc:postgresql://db:5433/app"
    assert (got["user"], got["password"]) == ("u", "p")
