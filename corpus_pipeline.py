"""From raw documents to shards: five stages, each an operator of ``rowharbor.llm``.

Every stage reads what the one before kept and returns the columns of documents; the
last returns shards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowharbor.llm import contamination, language, mixing, sharding, similarity
from rowharbor.llm.queries import MIX, domain
from rowharbor.llm.tables import table
from rowharbor.work_dir import work_dir

#: The mixture reads a document once at most and takes this share of all tokens.
TOKEN_SHARE = 0.8


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or of no clear language."""
    return language.recognised(docs, language.fit(docs))


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the least, of each class of near duplicates."""
    return similarity.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return contamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each source's share of the token budget."""
    return mixing.mixed(docs, MIX, domain=domain(), share=TOKEN_SHARE, max_epochs=1)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the documents in 24 shards of near equal size."""
    return sharding.shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("known_language", known_language),
    ("unlike", unlike),
    ("uncontaminated", uncontaminated),
    ("mixed", mixed),
    ("sharded", sharded),
]

#: Language scores and similarity classes have no SQL form; tests/llm compares the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of what all stages keep; each stage's rows are written once."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
