"""Change logs, catalogs and settings derived from the given tables.

The expressions are SQL that Spark and DuckDB read alike, so that the oracle
starts from the same text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowharbor.operators.catalog import table_lookup
from rowharbor.operators.lookup import Lookup, measured
from rowharbor.sources.change_log import log_position
from rowharbor.sources.spread import spread
from rowharbor.streaming.landing import flush_limits
from rowharbor.work_dir import files_below

PUBLICATION = "pub_o"
ORDERS_OID = "20001"
DOCUMENTS_OID = "20002"
VECTORS_OID = "20003"
LOG_FILES = 3
FILE_ROWS = 500_000
FLUSH_ROWS = 500
BATCH_BYTES = 65536
SLICES = 6
UPDATED_AT = "2024-06-01 00:00:00"

# Tables the change text points at; 16388 is not mapped at all.
EVENT_COLUMNS = [
    ("event_id", "int8"),
    ("user_id", "int8"),
    ("value", "numeric"),
    ("props", "jsonb"),
    ("flag", "bool"),
]
ORDER_COLUMNS = [
    ("o_orderkey", "int8"),
    ("o_custkey", "int8"),
    ("o_orderstatus", "bpchar"),
    ("o_totalprice", "float8"),
    ("o_orderdate", "timestamp"),
    ("o_orderpriority", "text"),
]
DOCUMENT_COLUMNS = [("doc_id", "int8"), ("lang", "text"), ("text", "text")]
VECTOR_COLUMNS = [("vec_id", "int8"), ("embedding", "_float4"), ("label", "int4"), ("raw", "bytea")]
TABLES = [
    ("16384", "users", EVENT_COLUMNS),
    ("16385", "orders", EVENT_COLUMNS[:3]),
    ("16386", "payments", None),
    ("16387", "unknown_table", None),
    (ORDERS_OID, "orders", ORDER_COLUMNS),
    (DOCUMENTS_OID, "documents", DOCUMENT_COLUMNS),
    (VECTORS_OID, "embeddings", VECTOR_COLUMNS),
]

SCOPED_TABLES = [(1, "orders"), (2, "sales")]
COPIED_TABLES = [
    ("40001", "region", "r_regionkey"),
    ("40002", "nation", "n_nationkey"),
    ("40003", "customer", "c_custkey"),
    ("40004", "orders", "o_orderkey"),
    ("40005", "supplier", None),
]

# Fifty type names for the fifty part sizes.
TYPE_NAMES = [
    "int2", "smallint", "int4", "integer", "serial", "int8", "bigint", "bigserial",
    "numeric", "decimal", "float4", "real", "float8", "double precision", "char",
    "bpchar", "varchar", "text", "name", "bool", "boolean", "date", "timestamp",
    "timestamp without time zone", "timestamptz", "timestamp with time zone", "time",
    "time without time zone", "timetz", "time with time zone", "bytea", "json",
    "jsonb", "uuid", "_int4", "_text", "_JSONB", "_", "interval", "inet", "money",
    "hstore", "", "INT4", "Numeric", "TEXT", "Double Precision", "BYTEA", "JsonB",
    "my_enum",
]

KIND = """CASE event_type WHEN 'signup' THEN 'Insert' WHEN 'purchase' THEN 'Update'
    WHEN 'error' THEN 'Delete' WHEN 'view' THEN 'Begin' ELSE 'Truncate' END"""
EVENT_TEXT = f"""concat({KIND}, '(', {KIND}, 'Event {{ table_id: TableId(',
    CAST(16384 + user_id % 5 AS string), '), values: [I64(', CAST(event_id AS string),
    '), I64(', CAST(user_id AS string), '), F64(', CAST(value AS string),
    '), String("', replace(props, '"', concat(chr(92), '"')), '"), ',
    CASE WHEN event_id % 7 = 0 THEN 'Null' WHEN event_id % 2 = 0 THEN 'Bool(true)'
         ELSE 'Bool(false)' END, '] }})')"""
ID_TEXT = """CASE event_type
    WHEN 'signup' THEN concat('TableId(', CAST(16384 + user_id % 5 AS string), ')')
    WHEN 'purchase' THEN concat('TableId { schema: ', CAST(user_id AS string),
        ', table: ', CAST(16384 + user_id % 5 AS string), ' }')
    WHEN 'error' THEN concat('TableId { table: "t', CAST(event_id AS string), '" }')
    WHEN 'view' THEN concat('{"x" (', CAST(event_id AS string), ') y ',
        CAST(user_id AS string), '}')
    ELSE concat('Insert(InsertEvent { table_id: TableId(',
        CASE WHEN user_id % 2 = 0 THEN repeat('9', 21) ELSE '' END,
        CAST(event_id AS string), '), values: [', props, '] })') END"""
ORDER_ID_TEXT = """CASE o_orderpriority
    WHEN '1-URGENT' THEN 'TableId(20001)'
    WHEN '2-HIGH' THEN 'TableId { schema: 2200, table: 20001 }'
    WHEN '3-MEDIUM' THEN 'TableId { schema: 2200, table: 16386 }'
    WHEN '5-LOW' THEN 'TableId { table: x20001, oid: TableId(20001) }'
    ELSE concat('TableId(', CAST(30000 + o_custkey % 3 AS string), ')') END"""
ORDER_ROW_TEXT = """concat('TableRow { values: [I64(', CAST(o_orderkey AS string),
    '), I64(', CAST(o_custkey AS string), '), String("', o_orderstatus, '"), F64(',
    CAST(o_totalprice AS string), '), ',
    CASE WHEN o_orderstatus = 'P' THEN 'Null'
         ELSE concat('String("', o_orderpriority, ', kept")') END, '] }')"""
DOCUMENT_ROW_TEXT = """concat('TableRow { values: [I64(', CAST(doc_id AS string),
    '), String("', lang, '"), String("', replace(text, '"', concat(chr(92), '"')),
    '")] }')"""
# As many events as this share a log position, as those of one transaction do.
EVENTS_AT_ONCE = 50
SHARED_LSN = f"concat('0/', hex(CAST(floor(event_id / {EVENTS_AT_ONCE}) AS bigint)))"
LSN = """concat(hex(CAST(floor(event_id / 7) AS bigint)), '/',
    hex(event_id % 7 * 268435456))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; times in it have no zone and are taken as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _column_list(pairs: list[tuple[str, str]] | None) -> str:
    if pairs is None:
        return "NULL"
    structs = [f"named_struct('name', '{n}', 'pg_type', '{t}')" for n, t in pairs]
    return f"array({', '.join(structs)})"


def event_lookup(spark: SparkSession) -> Lookup:
    """What is known of the tables that the change text points at."""
    rows = ", ".join(f"('{oid}', '{n}', {_column_list(c)})" for oid, n, c in TABLES)
    tables = spark.sql(f"SELECT * FROM VALUES {rows} AS t(oid, table_name, columns)")
    return measured(table_lookup(tables))


def scoped_lookup(spark: SparkSession) -> Lookup:
    """Two databases, each with a table of its own under the id of the orders."""
    columns = _column_list(ORDER_COLUMNS)
    rows = ", ".join(
        f"({pipeline}, '{ORDERS_OID}', '{name}', {columns})"
        for pipeline, name in SCOPED_TABLES
    )
    named = "t(pipeline_id, oid, table_name, columns)"
    return measured(table_lookup(spark.sql(f"SELECT * FROM VALUES {rows} AS {named}")))


def copied_lookup(spark: SparkSession) -> Lookup:
    """A catalog of given tables, one of them without columns."""
    rows = ", ".join(
        f"('{oid}', '{name}', {_column_list([(key, 'int8')] if key else None)})"
        for oid, name, key in COPIED_TABLES
    )
    tables = spark.sql(f"SELECT * FROM VALUES {rows} AS t(oid, table_name, columns)")
    return measured(table_lookup(tables))


def as_text_log(events: DataFrame, *kept: Column) -> DataFrame:
    return events.select(
        *kept,
        "event_id",
        F.col("user_id").cast("int").alias("pipeline_id"),
        F.expr(LSN).alias("lsn"),
        F.col("ts").cast("timestamp").alias("commit_ts"),
        F.expr(EVENT_TEXT).alias("event_text"),
    )


def text_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text_log(spread(table(spark, sf_dir, "events")))


def streamed_text_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    only_events = {"pathGlobFilter": "events.parquet"}
    return as_text_log(
        spark.readStream.schema(schema).options(**only_events).parquet(sf_dir)
    )


def log_in_files(
    spark: SparkSession, sf_dir: str, path: str, files: Sequence[int] = range(LOG_FILES)
) -> None:
    """The events as ``LOG_FILES`` files, written one after the other, so that a stream takes
    several batches; ``files`` says which of them. Of many events each of them is several
    files in turn, of about ``FILE_ROWS`` at most, that are written at once; events that
    share a log position are in one of these."""
    events = table(spark, sf_dir, "events")
    parts = -(-events.count() // (LOG_FILES * FILE_ROWS)) or 1
    bounds = events.approxQuantile("event_id", [n / LOG_FILES for n in range(1, LOG_FILES)], 0.01)
    ranges = list(zip([None, *bounds], [*bounds, None], strict=True))
    at_once = F.floor(F.col("event_id") / EVENTS_AT_ONCE)
    for low, high in (ranges[i] for i in files):
        above = F.lit(True) if low is None else F.col("event_id") >= low
        below = F.lit(True) if high is None else F.col("event_id") < high
        own = events.where(above & below).repartitionByRange(parts, at_once).sortWithinPartitions("event_id")
        own.write.mode("append").parquet(path)


def text_log_of_files(spark: SparkSession, path: str) -> DataFrame:
    """The log as a stream that takes it in some ``LOG_FILES`` batches."""
    schema = spark.read.parquet(path).schema
    found = len(files_below(spark, f"{path}/*.parquet"))
    options = flush_limits(max_files=-(-found // LOG_FILES) or 1)
    files = spark.readStream.schema(schema).options(**options).parquet(path)
    return as_text_log(files, log_position("parquet"))


def typed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = "CASE WHEN event_id % 7 <> 0 THEN event_id % 2 = 0 END"
    return spread(table(spark, sf_dir, "events")).select(
        "event_id",
        F.col("user_id").cast("int").alias("pipeline_id"),
        F.expr(LSN).alias("lsn"),
        F.col("ts").cast("timestamp").alias("commit_ts"),
        F.expr("16384 + user_id % 5").alias("table_oid"),
        F.expr(KIND).alias("kind"),
        F.array(
            F.col("event_id").cast("variant"),
            F.col("user_id").cast("variant"),
            F.col("value").cast("variant"),
            F.parse_json("props"),
            F.expr(flag).cast("variant"),
        ).alias("cells"),
    )


def order_rows_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "orders")).select(
        "o_orderkey",
        F.expr(ORDER_ID_TEXT).alias("table_id"),
        F.expr(ORDER_ROW_TEXT).alias("row_text"),
        F.col("o_orderdate").cast("timestamp").alias("read_ts"),
    )


def document_rows_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lit(f"TableId({DOCUMENTS_OID})").alias("table_id"),
        F.expr(DOCUMENT_ROW_TEXT).alias("row_text"),
        F.lit(UPDATED_AT).cast("timestamp").alias("read_ts"),
    )


def catalogs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The five catalogs: every order is a table in its customer's schema, every
    line item a column, every part a type. Line 1 is a system column, returned
    items are dropped columns, and the order status names the publication."""
    orders = table(spark, sf_dir, "orders")
    return [
        orders.selectExpr(
            "o_orderkey AS oid",
            "concat('t', CAST(o_orderkey AS string)) AS relname",
            "o_custkey AS relnamespace",
        ),
        table(spark, sf_dir, "customer").selectExpr(
            "c_custkey AS oid", "concat('s', CAST(c_custkey AS string)) AS nspname"
        ),
        orders.selectExpr(
            "concat('pub_', lower(o_orderstatus)) AS pubname",
            "concat('s', CAST(o_custkey AS string)) AS schemaname",
            "concat('t', CAST(o_orderkey AS string)) AS tablename",
        ),
        table(spark, sf_dir, "lineitem").selectExpr(
            "l_orderkey AS attrelid",
            "concat('c', CAST(l_linenumber AS string), '_', "
            "CAST(l_suppkey AS string)) AS attname",
            "l_partkey AS atttypid",
            "l_linenumber - 1 AS attnum",
            "l_returnflag = 'R' AS attisdropped",
        ),
        part_types(spark, sf_dir).selectExpr("p_partkey AS oid", "typname"),
    ]


def part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in TYPE_NAMES])
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.get(names, F.col("p_size") - 1).alias("typname")
    )


SETTINGS_FROM_SUPPLIER = [
    "CAST(s_suppkey AS int) AS id",
    "s_name AS host",
    "CAST(floor(s_acctbal * 10) AS int) AS port",
    "'etl' AS username",
    "'x' AS password",
    "concat('db', CAST(s_nationkey AS string)) AS dbname",
    "'pub' AS publication_name",
    "s_suppkey - 3 * s_nationkey AS replication_id",
]


def stored_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A settings table as stored, with ports that do not fit and negative ids."""
    return table(spark, sf_dir, "supplier").selectExpr(*SETTINGS_FROM_SUPPLIER)


#: Versions of the settings: which suppliers have a pipeline, and their database.
SETTINGS_VERSIONS = [
    ("s_acctbal >= 0", "concat('db', CAST(s_nationkey AS string))"),
    (
        "s_nationkey <> 3",
        "concat('db', CAST(s_nationkey AS string), CASE WHEN s_suppkey % 4 = 0 THEN '_v2' ELSE '' END)",
    ),
    (
        "s_suppkey % 7 <> 0",
        "concat('db', CAST(s_nationkey AS string), CASE WHEN s_suppkey % 6 = 0 THEN '_v3' ELSE '' END)",
    ),
]
#: Actions of the second poll that are not taken.
NOT_TAKEN = "id % 5 = 0"


def settings_versions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    suppliers = table(spark, sf_dir, "supplier")
    others = [c for c in SETTINGS_FROM_SUPPLIER if not c.endswith("AS dbname")]
    return [
        suppliers.where(rows).selectExpr(*others, f"{dbname} AS dbname")
        for rows, dbname in SETTINGS_VERSIONS
    ]


def settings_of_customers(customers: DataFrame, dbname: str) -> DataFrame:
    return customers.selectExpr(
        "CAST(c_custkey AS int) AS id",
        "c_name AS host",
        "5432 + c_nationkey AS port",
        "'etl' AS username",
        "CASE WHEN c_nationkey > 20 THEN NULL ELSE 'x' END AS password",
        f"{dbname} AS dbname",
        "'pub' AS publication_name",
        "CAST(c_custkey AS bigint) AS replication_id",
    )


RUNNING_DBNAME = "concat('db', CAST(c_nationkey AS string))"
DESIRED_DBNAME = (
    "concat('db', CAST(c_nationkey AS string), "
    "CASE WHEN c_mktsegment = 'BUILDING' THEN '_v2' ELSE '' END)"
)


def running_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipelines that run: of the customers with a finished order."""
    finished = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    customers = table(spark, sf_dir, "customer")
    busy = customers.join(
        finished.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi"
    )
    return settings_of_customers(busy, RUNNING_DBNAME)


def desired_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipelines asked for: of the customers not in debt, some changed."""
    solvent = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return settings_of_customers(solvent, DESIRED_DBNAME)


def stored_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter("c_acctbal >= 0").selectExpr(
        "CAST(c_custkey AS int) AS pipeline_id",
        "CASE WHEN c_nationkey = 0 THEN NULL ELSE '0/0' END AS last_lsn",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS updated_at",
    )
