"""Joining rows to what is known about their table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
SALTS = 32


@dataclass(frozen=True)
class Lookup:
    """A table with one row per key, and its measured size."""

    df: DataFrame
    size_bytes: int

    def keeping(self, df: DataFrame) -> Lookup:
        """The same lookup with rows or columns taken away."""
        return Lookup(df, self.size_bytes)


def measured(df: DataFrame) -> Lookup:
    """Measure a lookup; one aggregate over it reaches the driver."""
    size = df.agg(
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    ).first()[0]
    return Lookup(df, int(size))


def stored(df: DataFrame, path: str) -> Lookup:
    """Write a lookup once and read it back. A stream reads its lookup again in
    every batch; this way it sees the catalog as it was at the start."""
    df.write.mode("overwrite").parquet(path)
    return measured(df.sparkSession.read.parquet(path))


def attach(
    rows: DataFrame,
    lookup: Lookup,
    on: Sequence[str],
    how: str,
    salt_by: Sequence[str],
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Join rows to their lookup row.

    A lookup of at most ``limit_bytes`` is broadcast, so the rows stay where
    they are. A larger one is joined by shuffle: its rows are repeated once per
    salt and the rows spread over the salts by ``salt_by``, so a table that
    holds a third of all rows is still worked on by many tasks. Nothing stands
    between the join and its shuffles, so adaptive execution splits what one salt
    has too much of, at any size of the table.
    """
    if lookup.size_bytes <= limit_bytes:
        return rows.join(F.broadcast(lookup.df), list(on), how)
    salted = rows.withColumn(
        "_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int")
    )
    repeated = lookup.df.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
