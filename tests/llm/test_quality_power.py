"""The quality cutoffs use the whole risk: small strata get rules too."""

import random

from pyspark.sql import functions as F

from rowharbor.llm import quality

DOCS = "doc_id bigint, text string, lang string"
WORDS = [a + b for a in "ba ce di fo gu ha ki lo mu ne".split() for b in "n r st l m".split()]


def test_minority_strata_get_rules(spark):
    sizes = {"en": 2000, "de": 400, "fr": 400, "es": 160, "it": 30}
    rows, labels = [], []
    for lang, n in sizes.items():
        for k in range(n):
            i, rng = len(rows), random.Random(len(rows))
            words = [rng.choice(WORDS) for _ in range(60)]
            bad = k % 10 == 0
            rows.append((i, " ".join(w + "&&&" if bad else w for w in words), lang))
            labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = quality.judged(docs, marks).where("not base_failed").join(marks, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    kept = {(r.lang, r.quality): (r.kept, r.n) for r in got.groupBy("lang", "quality").agg(F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    for lang, n in sizes.items():
        assert kept[lang, 1][0] >= 0.95 * kept[lang, 1][1]
        # 30 labels cannot show it
        assert kept[lang, 0][0] == (0 if n > 100 else kept[lang, 0][1])
