"""Warehouse type labels and Spark types of the source's column types."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Source type name -> label written into the envelope's schema.
TYPE_LABELS = {
    "int2": "NUMBER(38,0)",
    "smallint": "NUMBER(38,0)",
    "int4": "NUMBER(38,0)",
    "integer": "NUMBER(38,0)",
    "serial": "NUMBER(38,0)",
    "int8": "NUMBER(38,0)",
    "bigint": "NUMBER(38,0)",
    "bigserial": "NUMBER(38,0)",
    "numeric": "NUMBER(38,0)",
    "decimal": "NUMBER(38,0)",
    "float4": "FLOAT",
    "real": "FLOAT",
    "float8": "FLOAT",
    "double precision": "FLOAT",
    "char": "VARCHAR",
    "bpchar": "VARCHAR",
    "varchar": "VARCHAR",
    "text": "VARCHAR",
    "name": "VARCHAR",
    "bool": "BOOLEAN",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP_LTZ",
    "timestamp without time zone": "TIMESTAMP_LTZ",
    "timestamptz": "TIMESTAMP_LTZ",
    "timestamp with time zone": "TIMESTAMP_LTZ",
    "time": "TIME",
    "time without time zone": "TIME",
    "timetz": "TIME",
    "time with time zone": "TIME",
    "bytea": "BINARY",
    "json": "VARIANT",
    "jsonb": "VARIANT",
    "uuid": "VARCHAR",
}
ARRAY_PREFIX = "_"
ARRAY_LABEL = "ARRAY"
DEFAULT_LABEL = "VARCHAR"

# Our choice of Spark type for a typed read of each source type.
SPARK_TYPES = {
    "int2": T.ShortType(),
    "smallint": T.ShortType(),
    "int4": T.IntegerType(),
    "integer": T.IntegerType(),
    "serial": T.IntegerType(),
    "int8": T.LongType(),
    "bigint": T.LongType(),
    "bigserial": T.LongType(),
    "numeric": T.DecimalType(38, 18),
    "decimal": T.DecimalType(38, 18),
    "float4": T.FloatType(),
    "real": T.FloatType(),
    "float8": T.DoubleType(),
    "double precision": T.DoubleType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp without time zone": T.TimestampType(),
    "timestamptz": T.TimestampType(),
    "timestamp with time zone": T.TimestampType(),
    "bytea": T.BinaryType(),
    "json": T.VariantType(),
    "jsonb": T.VariantType(),
}


def type_label(pg_type: Column) -> Column:
    """Label of a source type name, in any case; unknown names are VARCHAR."""
    name = F.lower(pg_type)
    labels = F.create_map(*[F.lit(x) for pair in TYPE_LABELS.items() for x in pair])
    return F.coalesce(
        F.try_element_at(labels, name),
        F.when(name.startswith(ARRAY_PREFIX), F.lit(ARRAY_LABEL)),
        F.lit(DEFAULT_LABEL),
    )


def spark_type(pg_type: str) -> T.DataType:
    """Spark type for a typed read of ``pg_type`` (arrays by their ``_`` name)."""
    name = pg_type.lower()
    if name.startswith(ARRAY_PREFIX):
        return T.ArrayType(spark_type(name[len(ARRAY_PREFIX) :]))
    return SPARK_TYPES.get(name, T.StringType())
