"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowharbor.llm import contamination as decontamination
from rowharbor.llm import (
    codes,
    extraction,
    language,
    licences,
    mixing,
    negatives,
    packing,
    quality,
    repeats,
    sharding,
    similarity,
    warc,
)
from rowharbor.llm.tables import table
from rowharbor.work_dir import work_dir

MIX = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "lang": {"en": 4, "*": 2},
    "source": {"*": 1},
}


def domain() -> Column:
    """Documents have no domain of their own: sources are dealt to four."""
    return F.concat(F.lit("d"), F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(4)))


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), MIX, domain=domain())


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out()))
    found = language.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scanned(docs, licences.fit(docs))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.contaminated(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.main_text(pages, extraction.fit(pages))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # imported here: only this query needs the vocabulary files
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer, with_ids=False)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mined(vectors, anchor=F.col("vec_id") % 50 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = codes.compressed(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_repeats, op2_mix, op3_language, op4_licences, op5_shards, op6_contamination, op7_html_text, op8_warc,
        op9_jaccard_join, op10_quality, op11_packing, op12_hard_negatives, op13_vector_codes,
    )
}
