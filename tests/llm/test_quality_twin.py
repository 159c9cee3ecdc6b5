"""The quality cutoffs against a plain program, over whole documents and labels."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rowharbor.llm import quality


def ratios(r):
    return {
        "symbols": min(r.n_symbols / max(r.word_chars, 1), 1),
        "capitals": min(r.n_capitals / max(r.word_chars, 1), 1),
        "marks": min(r.n_marks / max(r.n_words, 1), 1),
        "repeats": min(r.n_repeat_words / max(r.n_words, 1), 1),
        "lines": min(r.n_dup_lines / max(r.n_lines, 1), 1),
        "long_words": min(r.word_chars / max(r.n_words, 1) / 20, 1),
    }


def failed_base(r):
    return r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words


def usual(design):
    """By rule, the median bin and how far the upper tenth is from it."""
    found = {}
    for rule in quality.RULES:
        bins = sorted(math.ceil(x[rule] * 1000) for x in design)
        at = lambda share: next(b for i, b in enumerate(bins) if bins.count(b) and sum(c <= b for c in bins) / len(bins) >= share)
        half, most = at(0.5), at(0.9)
        found[rule] = (half / 1000, max((most - half) / 1000, 0.01))
    return found


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def plain_kept(rows, good):
    """kept by row; ``good`` counts a document's good labels, True for the design."""
    design, held = defaultdict(list), defaultdict(list)
    for r in rows:
        if not failed_base(r):
            for _ in range(good[r.doc_id]):
                (design if r.designing else held)[r.stratum].append(ratios(r))
    known = {s: usual(x) for s, x in design.items()}
    levels = [100 ** (1 - k / 39) for k in range(40)]

    def passes(x, s, level):
        return all(x[rule] <= m + d * levels[level] for rule, (m, d) in known[s].items())

    tested = {s: x for s, x in held.items() if s in known}
    chosen = {}
    for s, x in tested.items():
        for level in range(40):
            n_false = sum(not passes(y, s, level) for y in x)
            if not (n_false < len(x) * 0.05 and tail(n_false, len(x), 0.05) * len(tested) <= 1 - 0.95):
                break
            chosen[s] = level
    return Counter(
        (r.doc_id, not failed_base(r) and (r.stratum not in chosen or passes(ratios(r), r.stratum, chosen[r.stratum])))
        for r in rows
    ), chosen


@pytest.mark.parametrize("stratum", ["lang", "every"])
def test_cutoffs_of_whole_documents(spark, stratum):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("every", F.lit("one"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    designing = F.pmod(F.xxhash64(F.lit("levels"), "doc_id"), F.lit(quality.DESIGN)) == 0
    rows = quality.measured(docs, doc_id="doc_id", text="text", stratum=stratum)
    rows = rows.withColumn("designing", designing).collect()
    good = Counter(r.doc_id for r in labels.where("quality = 1").collect())
    want, chosen = plain_kept(rows, good)
    got = quality.judged(docs, labels, stratum=stratum).select("doc_id", "kept").collect()
    assert Counter(map(tuple, got)) == want
    assert chosen and any(not kept for _, kept in want)
