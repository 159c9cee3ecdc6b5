"""The same results as the queries, in SQL for DuckDB."""

from __future__ import annotations

from workload import inputs


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _columns(pairs: list[tuple[str, str]] | None) -> str:
    if pairs is None:
        return "NULL::VARCHAR[]"
    return "[" + ", ".join(_quoted(name) for name, _ in pairs) + "]"


CHANGES = f"""changes AS (SELECT event_id, CAST(user_id AS INTEGER) AS pipeline_id,
    {inputs.LSN} AS lsn, epoch_us(ts) // 1000 AS ts_ms, user_id, value, props,
    {inputs.EVENT_TEXT} AS event_text FROM events)"""
TABLES = "tables(oid, table_name, names) AS (VALUES " + ", ".join(
    f"({_quoted(o)}, {_quoted(n)}, {_columns(c)})" for o, n, c in inputs.TABLES
) + ")"
CONTROL = """(starts_with(lower(event_text), 'relation')
    OR starts_with(lower(event_text), 'begin')
    OR starts_with(lower(event_text), 'commit')
    OR starts_with(lower(event_text), 'type'))"""
OP = """CASE WHEN contains(lower(event_text), 'insert') THEN 'c'
    WHEN contains(lower(event_text), 'update') THEN 'u'
    WHEN contains(lower(event_text), 'delete') THEN 'd' END"""


def _oid(text: str) -> str:
    return f"""coalesce(
    nullif(CASE WHEN instr({text}, 'table:') > 0 THEN regexp_extract(
        substr({text}, instr({text}, 'table:') + 6), '^\\s*([0-9]+)', 1) END, ''),
    nullif(CASE WHEN instr({text}, 'TableId') > 0 THEN regexp_extract(
        substr({text}, instr({text}, 'TableId') + 7), '([0-9]+)', 1) END, ''),
    nullif(CASE WHEN strlen({text}) < 50
        THEN regexp_replace({text}, '[^0-9]', '', 'g') END, ''),
    '0')"""


def _change_oid(text: str) -> str:
    return f"""CASE WHEN strlen({_oid(text)}) <= 20 THEN {_oid(text)}
    WHEN instr({text}, 'table_id: ') > 0 THEN regexp_extract(
        substr({text}, instr({text}, 'table_id: ') + 10), '^([0-9]*)', 1)
    WHEN instr({text}, 'TableId(') > 0 THEN regexp_extract(
        substr({text}, instr({text}, 'TableId(') + 8), '^([0-9]*)', 1)
    ELSE '0' END"""


def _raw_id(text: str) -> str:
    return f"""CASE WHEN instr({text}, 'table:') > 0 THEN trim(regexp_extract(
        substr({text}, instr({text}, 'table:') + 6), '^([^,}}"]*)', 1))
    ELSE replace(regexp_replace({text}, '[(){{}}" ]', '', 'g'), 'TableId', '') END"""


LOCATED = f"""kept AS (SELECT *, {OP} AS op, {_change_oid('event_text')} AS oid
    FROM changes WHERE NOT {CONTROL} AND {OP} IS NOT NULL),
located AS (SELECT k.*, t.table_name, t.names FROM kept k JOIN tables t USING (oid)
    WHERE t.table_name <> 'unknown_table')"""

# Cells: a token list and the column names to one row per name.
INTEGER = "regexp_full_match(inner_text, '[+-]?[0-9]+')"
FLOAT = (
    "regexp_full_match(inner_text, "
    "'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"
)
NON_FINITE = "regexp_full_match(lower(inner_text), '[+-]?(inf|infinity|nan)')"


def _cells(tokens_from: str, keep: str) -> str:
    """``tokens_from`` has ``keep``, ``tokens`` and ``names``; the last of equal
    names wins."""
    return f"""tokens AS (SELECT {keep}, names, unnest(tokens) AS token,
        unnest(range(len(tokens))) AS i FROM {tokens_from}),
opened AS (SELECT {keep}, i, token,
        coalesce(names[i + 1], concat('col_', CAST(i AS VARCHAR))) AS key,
        CASE WHEN instr(token, '(') > 0
             THEN rtrim(substr(token, instr(token, '(') + 1), ')') END AS inner_text
    FROM tokens),
typed AS (SELECT *, CASE WHEN inner_text IS NULL THEN 'STRING'
        WHEN {INTEGER} AND TRY_CAST(inner_text AS BIGINT) IS NOT NULL THEN 'BIGINT'
        WHEN {INTEGER} OR {FLOAT} THEN 'DOUBLE'
        WHEN {NON_FINITE} THEN 'VOID' ELSE 'STRING' END AS stored_as FROM opened),
cells AS (SELECT {keep}, key, stored_as,
        CASE WHEN inner_text IS NULL THEN token
             WHEN stored_as = 'BIGINT' THEN CAST(CAST(inner_text AS BIGINT) AS VARCHAR)
             WHEN stored_as = 'DOUBLE' THEN CAST(CAST(inner_text AS DOUBLE) AS VARCHAR)
             WHEN stored_as = 'VOID' THEN NULL
             ELSE trim(inner_text, '"') END AS value
    FROM typed)"""


VALUE_LIST = """CASE WHEN instr(event_text, 'values: [') > 0
    THEN substr(event_text, instr(event_text, 'values: [') + 9) END"""
EVENT_TOKENS = f"""split_text AS (SELECT *, string_split(split_part({VALUE_LIST}, ']', 1),
    ', ') AS tokens FROM located)"""


def _row_tokens(rows: str) -> str:
    body = "regexp_replace(row_text, '^(TableRow)+', '')"
    return f"""split_text AS (SELECT *,
    string_split(trim({body}, ' ()[]{{}}'), ', ') AS tokens
    FROM {rows} WHERE names IS NOT NULL)"""


ORDER_ROWS = f"""printed AS (SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS ts_ms,
    {inputs.ORDER_ID_TEXT} AS table_id, {inputs.ORDER_ROW_TEXT} AS row_text FROM orders),
keyed AS (SELECT *, {_raw_id('table_id')} AS raw_id, {_oid('table_id')} AS oid
    FROM printed),
named AS (SELECT k.*, coalesce(n.table_name, k.raw_id) AS table_name, c.names
    FROM keyed k LEFT JOIN tables n ON n.oid = k.raw_id
    LEFT JOIN tables c ON c.oid = k.oid)"""

LABEL = """CASE
    WHEN lower(typname) IN ('int2', 'smallint', 'int4', 'integer', 'serial', 'int8',
        'bigint', 'bigserial', 'numeric', 'decimal') THEN 'NUMBER(38,0)'
    WHEN lower(typname) IN ('float4', 'real', 'float8', 'double precision') THEN 'FLOAT'
    WHEN lower(typname) IN ('bool', 'boolean') THEN 'BOOLEAN'
    WHEN lower(typname) = 'date' THEN 'DATE'
    WHEN lower(typname) IN ('timestamp', 'timestamp without time zone', 'timestamptz',
        'timestamp with time zone') THEN 'TIMESTAMP_LTZ'
    WHEN lower(typname) IN ('time', 'time without time zone', 'timetz',
        'time with time zone') THEN 'TIME'
    WHEN lower(typname) = 'bytea' THEN 'BINARY'
    WHEN lower(typname) IN ('json', 'jsonb') THEN 'VARIANT'
    WHEN starts_with(typname, '_') THEN 'ARRAY'
    ELSE 'VARCHAR' END"""
PART_TYPES = (
    "part_types AS (SELECT p_partkey, ["
    + ", ".join(_quoted(n) for n in inputs.TYPE_NAMES)
    + "][p_size] AS typname FROM part)"
)
CATALOG = f"""{PART_TYPES},
columns AS (SELECT CAST(o.o_orderkey AS VARCHAR) AS oid,
        concat('t', CAST(o.o_orderkey AS VARCHAR)) AS relname,
        l.l_linenumber - 1 AS attnum,
        concat('c', CAST(l_linenumber AS VARCHAR), '_', CAST(l_suppkey AS VARCHAR))
            AS attname,
        typname, concat('s', CAST(o.o_custkey AS VARCHAR)) AS nspname
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    JOIN part_types ON p_partkey = l_partkey
    WHERE concat('pub_', lower(o_orderstatus)) = '{inputs.PUBLICATION}'
        AND l_linenumber > 1 AND l_returnflag <> 'R')"""

SETTINGS = ", ".join(
    ("id", "host", "port", "username", "password", "dbname", "publication_name")
)


def _settings(dbname: str) -> str:
    return f"""SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS host,
        5432 + c_nationkey AS port, 'etl' AS username,
        CASE WHEN c_nationkey > 20 THEN NULL ELSE 'x' END AS password,
        {dbname} AS dbname, 'pub' AS publication_name,
        CAST(c_custkey AS BIGINT) AS replication_id FROM customer"""


RUNNING = f"""running AS ({_settings(inputs.RUNNING_DBNAME)} WHERE c_custkey IN
    (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'))"""
DESIRED = f"""desired AS ({_settings(inputs.DESIRED_DBNAME)} WHERE c_acctbal >= 0)"""
POSITIONS = """positions AS (SELECT CAST(user_id AS INTEGER) AS pipeline_id,
    max(event_id) AS event_id FROM events GROUP BY user_id),
latest AS (SELECT p.pipeline_id, lsn AS last_lsn
    FROM positions p JOIN changes c ON c.event_id = p.event_id)"""
MERGED = f"""stored AS (SELECT CAST(c_custkey AS INTEGER) AS pipeline_id,
    CASE WHEN c_nationkey = 0 THEN NULL ELSE '0/0' END AS last_lsn,
    '2024-01-01 00:00:00' AS updated_at FROM customer WHERE c_acctbal >= 0),
merged AS (SELECT coalesce(l.pipeline_id, s.pipeline_id) AS pipeline_id,
    CASE WHEN l.pipeline_id IS NOT NULL THEN l.last_lsn ELSE s.last_lsn END AS last_lsn,
    CASE WHEN l.pipeline_id IS NOT NULL THEN '{inputs.UPDATED_AT}'
         ELSE s.updated_at END AS updated_at
    FROM stored s FULL JOIN latest l ON l.pipeline_id = s.pipeline_id)"""
LANDED = """SELECT 'ORDERS_CDC' AS cdc_table, 'c' AS operation FROM orders
    UNION ALL SELECT concat(upper(table_name), '_CDC'), op FROM located"""
COUNTED = f"""WITH {CHANGES}, {TABLES}, {LOCATED}, landed AS ({LANDED})
SELECT cdc_table, operation, count(*) AS "rows" FROM landed GROUP BY ALL"""
TYPED_LOCATED = f"""typed AS (SELECT event_id, user_id, value, props, event_type,
        epoch_us(ts) // 1000 AS ts_ms, CAST(user_id AS INTEGER) AS pipeline_id,
        {inputs.LSN} AS lsn, CAST(16384 + user_id % 5 AS VARCHAR) AS oid,
        CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'u'
            WHEN 'error' THEN 'd' END AS op FROM events),
located AS (SELECT * FROM typed JOIN tables USING (oid)
    WHERE op IS NOT NULL AND table_name <> 'unknown_table')"""

REJECTED = f"""WITH {CHANGES}, {TABLES},
judged AS (SELECT event_id, {_change_oid('event_text')} AS oid,
    CASE WHEN {CONTROL} THEN 'control' WHEN {OP} IS NULL THEN 'no operation' END AS early
    FROM changes),
reasons AS (SELECT event_id, j.oid, coalesce(early,
    CASE WHEN t.oid IS NULL THEN 'no table' END) AS reason FROM judged j
    LEFT JOIN tables t ON t.oid = j.oid AND t.table_name <> 'unknown_table')
SELECT * FROM reasons WHERE reason IS NOT NULL"""
LOCATED_POSITIONS = """positions AS (SELECT pipeline_id, max(event_id) AS event_id
    FROM located GROUP BY pipeline_id)"""
SCOPED = " UNION ALL ".join(
    f"""SELECT '{name.upper()}_CDC' AS cdc_table, {pipeline} AS pipeline_id,
    '{name}' AS schema_name, o_orderkey,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at FROM orders"""
    for pipeline, name in inputs.SCOPED_TABLES
)
COPIED = " UNION ALL ".join(
    f"""SELECT '{name.upper()}_CDC' AS cdc_table, 'c' AS operation,
    CAST({key or 's_suppkey'} AS BIGINT) AS key FROM {name}"""
    for _, name, key in inputs.COPIED_TABLES
)

LANDED_ROWS = f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT concat(upper(table_name), '_CDC') AS cdc_table, op AS operation, ts_ms,
    pipeline_id, lsn, event_id AS payload_id FROM located"""

IN_CATALOG = f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT concat(upper(table_name), '_CDC') AS cdc_table, op AS operation,
    true AS is_timed, event_id AS payload_id FROM located"""
IN_BOUNDS = f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT concat(upper(table_name), '_CDC') AS cdc_table, true AS in_bounds,
    op AS operation, event_id AS payload_id FROM located"""

POLLED = ", ".join(
    f"v{n} AS (SELECT CAST(s_suppkey AS INTEGER) AS id, {dbname} AS dbname FROM supplier WHERE {rows})"
    for n, (rows, dbname) in enumerate(inputs.SETTINGS_VERSIONS, 1)
) + f""", running AS (SELECT * FROM v2 WHERE NOT ({inputs.NOT_TAKEN})
    UNION ALL SELECT * FROM v1 WHERE {inputs.NOT_TAKEN})"""


def _action(old: str, new: str) -> str:
    return f"""coalesce(o.id, n.id), CASE WHEN o.id IS NULL THEN 'start' WHEN n.id IS NULL THEN 'stop'
    WHEN o.dbname = n.dbname THEN 'keep' ELSE 'restart' END
    FROM {old} o FULL JOIN {new} n ON o.id = n.id"""


ORACLES: dict[str, str] = {
    "change_counts": f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT table_name, op, count(*) AS changes FROM located GROUP BY ALL""",
    "change_ops": f"""WITH {CHANGES}
SELECT event_id, {OP} AS op FROM changes WHERE NOT {CONTROL} AND {OP} IS NOT NULL""",
    "change_table_ids": f"""WITH ids AS (SELECT event_id, {inputs.ID_TEXT} AS id_text
    FROM events)
SELECT event_id, {_raw_id('id_text')} AS raw_id, {_oid('id_text')} AS oid,
    {_change_oid('id_text')} AS change_oid FROM ids""",
    "table_lookup_inner": f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT event_id, oid, table_name, CAST(coalesce(len(names), 0) AS INTEGER) AS n_columns
FROM located""",
    "table_lookup_left": f"""WITH {TABLES}, {ORDER_ROWS}
SELECT o_orderkey, raw_id, oid, table_name,
    CAST(coalesce(len(names), 0) AS INTEGER) AS n_columns FROM named""",
    "rejected_changes": REJECTED,
    "catalog_columns": f"WITH {CATALOG} SELECT * FROM columns",
    "catalog_schema": f"""WITH {CATALOG}
SELECT oid, min(relname) AS table_name, CAST(count(*) AS INTEGER) AS n_columns,
    string_agg(concat(attname, ' ', typname), '|' ORDER BY attnum, attname, typname)
        AS columns_text
FROM columns GROUP BY oid""",
    "mapped_tables": f"""WITH {CATALOG}
SELECT count(DISTINCT oid) AS mapped_tables FROM columns""",
    "type_labels": f"""WITH {PART_TYPES}
SELECT p_partkey, typname, {LABEL} AS label FROM part_types""",
    "schema_fields": f"""WITH {CATALOG}
SELECT oid, relname AS table_name, 'struct' AS schema_type,
    CAST(row_number() OVER (PARTITION BY oid ORDER BY attnum, attname, typname) - 1
        AS INTEGER) AS position,
    attname AS field, {LABEL} AS type, true AS optional FROM columns""",
    "payload_cells": f"""WITH {CHANGES}, {TABLES}, {LOCATED}, {EVENT_TOKENS},
{_cells('split_text', 'event_id')}
SELECT event_id, key, value, stored_as FROM cells""",
    "envelopes": f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT event_id, pipeline_id, lsn, concat(upper(table_name), '_CDC') AS cdc_table, op,
    ts_ms, table_name AS schema_name,
    CASE WHEN names IS NOT NULL THEN 'struct' END AS schema_type,
    CAST(coalesce(len(names), 0) AS INTEGER) AS n_fields, event_id AS payload_id
FROM located""",
    "typed_envelopes": f"""WITH {TABLES}, {TYPED_LOCATED}
SELECT event_id, concat(upper(table_name), '_CDC') AS cdc_table, op, ts_ms,
    table_name AS schema_name, CASE WHEN names IS NOT NULL THEN 'struct' END
        AS schema_type,
    CAST(coalesce(len(names), 0) AS INTEGER) AS n_fields, user_id, value,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS props_k,
    CASE WHEN event_id % 7 <> 0 THEN event_id % 2 = 0 END AS flag FROM located""",
    "snapshot_rows": """SELECT 'ORDERS_CDC' AS cdc_table, 'c' AS op,
    epoch_us(o_orderdate) // 1000 AS ts_ms, 'orders' AS schema_name,
    'struct' AS schema_type, CAST(6 AS INTEGER) AS n_fields, o_orderkey, o_custkey,
    o_orderstatus, o_totalprice, o_orderpriority,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at FROM orders""",
    "snapshot_cells": """SELECT 'EMBEDDINGS_CDC' AS cdc_table, vec_id,
    CAST(embedding[2] AS DOUBLE) AS second, CAST(len(embedding) AS INTEGER) AS n_components,
    CAST(CASE WHEN vec_id % 3 <> 0 THEN label END AS INTEGER) AS label, true AS has_label_key,
    concat('v', CAST(vec_id AS VARCHAR)) AS raw FROM embeddings""",
    "snapshot_text_rows": f"""WITH {TABLES}, {ORDER_ROWS}, {_row_tokens('named')},
{_cells('split_text', 'o_orderkey, table_name, ts_ms')},
all_cells AS (SELECT o_orderkey, table_name, ts_ms, table_name AS schema_name, key,
        value, stored_as FROM cells
    UNION ALL SELECT o_orderkey, table_name, ts_ms, NULL, 'data', row_text, 'STRING'
        FROM named WHERE names IS NULL)
SELECT o_orderkey, concat(upper(table_name), '_CDC') AS cdc_table, 'c' AS op, ts_ms,
    schema_name, key, value, stored_as FROM all_cells""",
    "snapshot_documents": f"""WITH {TABLES},
named AS (SELECT doc_id, {inputs.DOCUMENT_ROW_TEXT} AS row_text, names
    FROM documents, tables WHERE oid = '{inputs.DOCUMENTS_OID}'),
{_row_tokens('named')}, {_cells('split_text', 'doc_id')}
SELECT doc_id, 'DOCUMENTS_CDC' AS cdc_table, key, value, stored_as FROM cells""",
    "batch_flatten": f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT concat(upper(table_name), '_CDC') AS cdc_table, event_id // 500 AS batch,
    op AS operation, table_name AS schema_name, event_id AS payload_id FROM located""",
    "batch_bounds": IN_BOUNDS,
    "landed_counts": COUNTED,
    "landed_stream": f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT concat(upper(table_name), '_CDC') AS cdc_table, op AS operation, ts_ms, lsn,
    event_id AS payload_id FROM located
UNION ALL SELECT 'ORDERS_CDC', 'c', NULL, NULL, o_orderkey FROM orders""",
    "landed_table": f"""WITH {TABLES}, {TYPED_LOCATED}
SELECT event_id, value, op AS operation, ts_ms, pipeline_id, lsn FROM located
WHERE table_name = 'users'""",
    "landed_catalog_tables": IN_CATALOG,
    "followed_catalog_tables": IN_CATALOG,
    "bounded_landings": IN_BOUNDS,
    "batch_bytes": f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT concat(upper(table_name), '_CDC') AS cdc_table, true AS in_bounds, true AS is_numbered,
    op AS operation, event_id AS payload_id FROM located""",
    "sliced_copy": f"""SELECT 'ORDERS_CDC' AS cdc_table, 'c' AS operation, o_orderkey,
    CAST({inputs.SLICES} AS BIGINT) AS n_slices FROM orders""",
    "migrated_rows": f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT concat(upper(table_name), '_CDC') AS cdc_table,
    concat('batch-', CAST(event_id % 4 AS VARCHAR)) AS land_id, op AS operation,
    table_name AS schema_name, event_id AS payload_id FROM located""",
    "scoped_snapshot": SCOPED,
    "copied_tables": COPIED,
    "followed_rows": LANDED_ROWS,
    "resumed_rows": LANDED_ROWS,
    "landed_compacted": LANDED_ROWS,
    "landed_order": f"""WITH {CHANGES}, {TABLES}, {LOCATED}
SELECT concat(upper(table_name), '_CDC') AS cdc_table, {inputs.SHARED_LSN} AS lsn,
    row_number() OVER (PARTITION BY upper(table_name) ORDER BY event_id) - 1 AS number,
    event_id AS payload_id FROM located""",
    "followed_rejects": REJECTED,
    "followed_positions": f"""WITH {CHANGES}, {TABLES}, {LOCATED}, {LOCATED_POSITIONS}
SELECT p.pipeline_id, c.lsn AS last_lsn
FROM positions p JOIN changes c ON c.event_id = p.event_id""",
    "config_scan": """SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS host,
    CAST(((CAST(floor(s_acctbal * 10) AS BIGINT) % 65536) + 65536) % 65536 AS INTEGER)
        AS port,
    'etl' AS username, 'x' AS password,
    concat('db', CAST(s_nationkey AS VARCHAR)) AS dbname, 'pub' AS publication_name,
    CAST(CAST(s_suppkey - 3 * s_nationkey AS HUGEINT)
        + CASE WHEN s_suppkey < 3 * s_nationkey THEN 18446744073709551616::HUGEINT
               ELSE 0::HUGEINT END AS VARCHAR) AS replication_id
FROM supplier""",
    "config_diff": f"""WITH {RUNNING}, {DESIRED}
SELECT coalesce(r.id, d.id) AS id, CASE WHEN r.id IS NULL THEN 'start'
    WHEN d.id IS NULL THEN 'stop'
    WHEN r.host = d.host AND r.port = d.port AND r.username = d.username
        AND r.password IS NOT DISTINCT FROM d.password AND r.dbname = d.dbname
        AND r.publication_name = d.publication_name
        AND r.replication_id = d.replication_id THEN 'keep'
    ELSE 'restart' END AS action
FROM running r FULL JOIN desired d ON r.id = d.id""",
    "config_polls": f"""WITH {POLLED}
SELECT 1 AS poll, id, 'start' AS action FROM v1
UNION ALL SELECT 2, {_action('v1', 'v2')}
UNION ALL SELECT 3, {_action('running', 'v3')}""",
    "config_removed": f"""WITH {RUNNING}, {DESIRED}
SELECT id FROM running EXCEPT SELECT id FROM desired""",
    "latest_positions": f"""WITH {CHANGES}, {POSITIONS}
SELECT pipeline_id, last_lsn FROM latest""",
    "offset_upsert": f"""WITH {CHANGES}, {POSITIONS}, {MERGED} SELECT * FROM merged""",
    "offset_lookup": f"""WITH {CHANGES}, {POSITIONS}, {MERGED}
SELECT last_lsn FROM merged WHERE pipeline_id = 7 LIMIT 1""",
}
