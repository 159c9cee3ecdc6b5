import pytest

import __spark_entry__ as spark_entry
from oracle_check import difference, duck
from workload.oracles import ORACLES as workload_oracles
from workload.queries import QUERIES as workload_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = spark_entry.queries()
ORACLES = spark_entry.oracle_sql()


def test_every_query_has_its_sql():
    assert set(workload_queries) == set(workload_oracles)


@pytest.mark.parametrize("name", list(workload_queries))
def test_query_against_sql(spark, name):
    assert difference(spark, duck(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) == ""


def test_entry(spark):
    rows = spark_entry.entry(spark)
    assert rows.columns == ["table_name", "op", "changes"] and rows.count() > 0
