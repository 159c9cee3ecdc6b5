"""Documents keep their own columns, whatever these are called; hot payloads are split."""

from pyspark.sql import functions as F

from rowharbor.llm import contamination, language, mixing, repeats, tables, warc
from rowharbor.llm.queries import MIX, domain

CLASHING = ["row_key", "copies", "_copy", "n_words", "n_hit", "matches", "_hits", "score", "lang_pred", "own_0", "document"]


def docs(spark):
    rows = [(i, "de" if i % 2 else "en", f"s{i % 3}", f"some words of document {i} and others " * 3) for i in range(12)]
    rows.append((12, "en", "s0", "the hidden benchmark passage has ten words in a row here now"))
    found = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    return found.withColumns({c: F.concat(F.lit(f"{c}-"), "doc_id") for c in CLASHING})


def kept(df):
    return {r.doc_id: tuple(r[c] for c in CLASHING) for r in df.collect()}


def own(spark, ids):
    return {i: tuple(f"{c}-{i}" for c in CLASHING) for i in ids}


def test_filters_keep_clashing_columns(spark):
    all_docs = docs(spark)
    items = spark.createDataFrame([(1, "hidden benchmark passage has ten words in a row here now")], "item_id long, text string")
    clean = contamination.uncontaminated(all_docs, items)
    assert clean.columns == all_docs.columns and kept(clean) == own(spark, range(12))
    known = language.recognised(all_docs, language.fit(all_docs), min_score=0.0)
    assert known.columns == all_docs.columns and kept(known) == own(spark, range(13))
    mixed = mixing.mixed(all_docs, MIX, domain=domain(), share=1.0, max_epochs=1)
    assert mixed.columns == all_docs.columns
    got = kept(mixed)
    assert got and got == own(spark, got)


def test_a_payload_that_many_pages_have(spark, tmp_path, monkeypatch):
    hot, cold = "x" * 300, "y" * 300
    rows = [(i, "u", hot if i % 3 else f"{cold}{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    for limit, name in ((10, "a"), (0, "b")):
        monkeypatch.setattr(warc, "BROADCAST_ROWS", limit)
        warc.write_archives(pages, str(tmp_path / name))
        found = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_records(spark, str(tmp_path / name)).collect()}
        want = {i: ("response", None) if i % 3 == 0 or i == 1 else ("revisit", 1) for i in range(300)}
        assert found == want


def test_repeats_among_rows_that_share_an_id(spark):
    passage = "a passage that is longer than fifty bytes and stands in several documents "
    rows = [(None, passage + "one"), (None, passage + "two"), (1, passage + "three"), (1, passage + "three"), (2, passage + "three")]
    found = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    removed = sorted((str(r.doc_id), r.n_removed) for r in found)
    n = len(passage)
    # "two" and "three" share their first letter too
    assert removed == [("1", 0), ("1", 0), ("2", n + 5), ("None", n), ("None", n + 1)]


def test_settled_rows_are_read_again(spark):
    assert tables.settled(spark.range(3)).count() == 3
