"""Where a job keeps what it writes for itself."""

from __future__ import annotations

import functools
import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Names that ``work_dir`` gives.
OWN_NAME = re.compile(r".-[0-9a-f]{32}$")


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="rowharbor-")


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a directory that ``work_dir`` named, wherever it is stored."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def files_below(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Paths that match a pattern, each with the hours since it was last changed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    now = time.time() * 1000
    return [(f.getPath().toString(), (now - f.getModificationTime()) / 3_600_000) for f in found]


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a directory."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def _shared_folder(spark: SparkSession) -> str:
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a shared folder")
    return _local_folder()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new directory for ``name`` in the folder all executors share, as the
    session names it. Only a local session may do without the setting."""
    return f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_old_work(spark: SparkSession, hours: float) -> list[str]:
    """Delete the directories of ``work_dir`` that were made more than ``hours`` ago: what
    results were read from may be needed until they are written elsewhere. Returns what
    was deleted; other files in the folder stay."""
    found = files_below(spark, f"{_shared_folder(spark)}/*")
    old = [path for path, age in found if age > hours and OWN_NAME.search(path.rsplit("/", 1)[-1])]
    for path in old:
        remove_dir(spark, path)
    return old
