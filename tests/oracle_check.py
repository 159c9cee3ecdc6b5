"""Comparing a query's rows with its SQL counterpart's."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty when columns and rows agree, else what differs."""
    df = query(spark, sf_dir)
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    left, right = bag(got_columns, got), bag(want_columns, want)
    if left != right:
        return (
            f"{len(got)} rows against {len(want)}; only in query: "
            f"{list((left - right).items())[:3]}; only in SQL: "
            f"{list((right - left).items())[:3]}"
        )
    return "" if got else "no rows"
