"""Reading the given tables and settling what several steps read again."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowharbor.work_dir import CHECKPOINT_SETTING


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the folder all executors share, so that
    a lost executor costs no recomputation and iterations do not grow the plan."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get(CHECKPOINT_SETTING, None)
        if not shared and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a shared folder")
        spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="rowharbor-"))
    return df.checkpoint()


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts: one pass, one number."""
    return df.select(F.sum(F.octet_length(text))).first()[0] or 0


def with_own_columns(docs: DataFrame, choose: Callable[[DataFrame, dict[str, str]], DataFrame]) -> DataFrame:
    """What ``choose`` keeps of ``docs``, with their own columns, whatever these are called.
    It sees them under names that nothing else has, and a map from the one to the other."""
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    return choose(docs.toDF(*names.values()), names).select(*names.values()).toDF(*docs.columns)
