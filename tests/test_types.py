import pytest
from pyspark.sql import functions as F, types as T

from rowharbor.functions.types import TYPE_LABELS, spark_type, type_label

EXPECTED = {
    "int2": "NUMBER(38,0)", "SMALLINT": "NUMBER(38,0)", "Int4": "NUMBER(38,0)",
    "integer": "NUMBER(38,0)", "serial": "NUMBER(38,0)", "int8": "NUMBER(38,0)",
    "bigint": "NUMBER(38,0)", "bigserial": "NUMBER(38,0)", "numeric": "NUMBER(38,0)",
    "decimal": "NUMBER(38,0)", "float4": "FLOAT", "real": "FLOAT", "float8": "FLOAT",
    "Double Precision": "FLOAT", "char": "VARCHAR", "bpchar": "VARCHAR",
    "varchar": "VARCHAR", "text": "VARCHAR", "name": "VARCHAR", "bool": "BOOLEAN",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP_LTZ",
    "timestamp without time zone": "TIMESTAMP_LTZ", "timestamptz": "TIMESTAMP_LTZ",
    "timestamp with time zone": "TIMESTAMP_LTZ", "time": "TIME",
    "time without time zone": "TIME", "timetz": "TIME", "time with time zone": "TIME",
    "bytea": "BINARY", "json": "VARIANT", "jsonb": "VARIANT", "uuid": "VARCHAR",
    "_int4": "ARRAY", "_TEXT": "ARRAY", "_": "ARRAY", "interval": "VARCHAR",
    "inet": "VARCHAR", "money": "VARCHAR", "": "VARCHAR", "my_enum": "VARCHAR",
}


def test_labels(spark):
    rows = spark.createDataFrame([(n,) for n in EXPECTED], "n string")
    got = {r[0]: r[1] for r in rows.select("n", type_label(F.col("n"))).collect()}
    assert got == EXPECTED


def test_every_known_name_is_covered():
    assert set(TYPE_LABELS) <= {n.lower() for n in EXPECTED}


@pytest.mark.parametrize(
    "name, expected",
    [
        ("int2", T.ShortType()),
        ("INT4", T.IntegerType()),
        ("numeric", T.DecimalType(38, 18)),
        ("jsonb", T.VariantType()),
        ("time", T.StringType()),
        ("interval", T.StringType()),
        ("_int8", T.ArrayType(T.LongType())),
    ],
)
def test_spark_types(name, expected):
    assert spark_type(name) == expected
