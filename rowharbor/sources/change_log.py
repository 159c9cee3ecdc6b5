"""Change logs as they were landed by a capture process.

A log is a directory of Parquet, JSON or text files, or a Kafka topic whose
values are JSON. Batch and streaming reads give the same columns. Every record has its
``position`` in the log.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TEXT_LOG = "pipeline_id INT, lsn STRING, commit_ts TIMESTAMP, event_text STRING"
TYPED_LOG = (
    "pipeline_id INT, lsn STRING, commit_ts TIMESTAMP, table_oid LONG, "
    "kind STRING, cells ARRAY<VARIANT>"
)
# Typed logs in JSON carry the cells as one JSON array.
TYPED_JSON = (
    "pipeline_id INT, lsn STRING, commit_ts TIMESTAMP, table_oid LONG, "
    "kind STRING, cells STRING"
)
# Where a JSON record that cannot be read keeps its text.
BAD_RECORD = "bad_record"
_KEEP_BAD = {"columnNameOfCorruptRecord": BAD_RECORD}


def log_position(file_format: str) -> Column:
    """Where a record stands in a log of files, for the order of its records: time and
    name of the file, then the row. Parquet counts the rows of a file; of text and JSON
    there is the slice that is read at once, and ``numbered`` adds the row."""
    block, row = F.col("_metadata.file_block_start"), F.lit(None).cast("long")
    if file_format == "parquet":
        block, row = F.lit(0).cast("long"), F.col("_metadata.row_index")
    return F.struct(
        F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("file"),
        block.alias("block"),
        row.alias("row"),
    ).alias("position")


def numbered(log: DataFrame) -> DataFrame:
    """Records with a row in their position, also those of text and JSON: a task reads a
    slice in order, so the record's number in the task is in order too. For a batch (or
    micro-batch) as it is read, before rows are moved."""
    if "position" not in log.columns or log.isStreaming:
        return log
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    row = F.coalesce(F.col("position.row"), in_task)
    return log.withColumn("position", F.col("position").withField("row", row))


def _with_bad_record(schema: str) -> str:
    return f"{schema}, {BAD_RECORD} STRING"


def _load(
    spark: SparkSession,
    file_format: str,
    schema: str,
    path: str,
    streaming: bool,
    options: Mapping[str, str],
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    if file_format == "json":
        schema, options = _with_bad_record(schema), {**options, **_KEEP_BAD}
    log = reader.format(file_format).schema(schema).options(**options).load(path)
    log = log.select("*", log_position(file_format))
    return log if file_format == "parquet" else numbered(log)


def parsed_cells(log: DataFrame) -> DataFrame:
    """A typed log whose cells are still JSON text, with the cells as variants.
    ``bad_cells`` keeps text that is not a JSON array; its ``cells`` are null."""
    parsed = F.try_parse_json("cells")
    cells = F.try_variant_get(parsed, "$", "array<variant>")
    return log.withColumn("parsed", cells).select(
        *[c for c in log.columns if c != "cells"],
        F.col("parsed").alias("cells"),
        F.when(F.col("parsed").isNull(), F.col("cells")).alias("bad_cells"),
    )


def read_text_log(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    streaming: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Text change records. Plain text files hold one record per line and no
    position or time: those come out as null and as the file's time. Lines of JSON
    files that cannot be read are kept as text in ``bad_record``, else null."""
    options = options or {}
    if file_format == "text":
        lines = _load(spark, "text", "value STRING", path, streaming, options)
        return lines.select(
            F.lit(None).cast("int").alias("pipeline_id"),
            F.lit(None).cast("string").alias("lsn"),
            F.col("position.at").alias("commit_ts"),
            F.col("value").alias("event_text"),
            "position",
        )
    return _load(spark, file_format, TEXT_LOG, path, streaming, options)


def read_typed_log(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    streaming: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typed change records, from Parquet or JSON files; ``bad_record`` of JSON files
    as in ``read_text_log``."""
    options = options or {}
    if file_format == "json":
        return parsed_cells(
            _load(spark, "json", TYPED_JSON, path, streaming, options)
        )
    return _load(spark, file_format, TYPED_LOG, path, streaming, options)


def read_kafka_log(
    spark: SparkSession,
    options: Mapping[str, str],
    typed: bool = False,
    streaming: bool = True,
) -> DataFrame:
    """Change records from Kafka; needs Spark's Kafka package on the class path."""
    reader = spark.readStream if streaming else spark.read
    values = reader.format("kafka").options(**options).load()
    schema = TYPED_JSON if typed else TEXT_LOG
    # a partition of a topic is read in order; its offset is the row
    position = F.struct(
        F.lit(None).cast("timestamp").alias("at"),
        F.concat_ws("-", "topic", "partition").alias("file"),
        F.lit(0).cast("long").alias("block"),
        F.col("offset").alias("row"),
    )
    log = values.select(
        F.from_json(
            F.col("value").cast("string"), _with_bad_record(schema), _KEEP_BAD
        ).alias("record"),
        position.alias("position"),
    ).select("record.*", "position")
    return parsed_cells(log) if typed else log
