import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from oracle_check import difference, duck
from rowharbor.llm.oracles import ORACLES
from rowharbor.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_sql(spark, name):
    assert difference(spark, duck(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) == ""


def test_all_queries_are_registered():
    assert [f"op{n}" for n in range(1, 14)] == [q.split("_")[0] for q in QUERIES]
    assert set(QUERIES) | {"pipeline"} <= set(spark_entry.queries())


def test_pipeline_keeps_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns and 0 < kept.count() <= before
    sharded = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in sharded.collect()} == {r.doc_id for r in kept.collect()}
