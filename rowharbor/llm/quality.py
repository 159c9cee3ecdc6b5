"""Quality rules whose cutoffs carry a guarantee on good documents.

Each rule is a ratio with a cutoff above which a document is rejected. Cutoffs are
chosen per stratum (language) on a labelled holdout. All rules are tightened together
along one sequence of ``GRID`` levels, from the loosest: the cutoff of a rule is so many
spreads above its usual value. Usual values and spreads come from one in
``DESIGN`` of the good documents, which are then in no test. Level by level, "more than
``max_false`` of the good documents of this stratum fail any rule" is tested by the
exact binomial test on the others; the last level before the first that is not refuted
is taken. As the levels are nested and their order does not depend on the documents
tested, every test has the full risk, and the confidence is divided by the strata only.
A stratum whose labels cannot refute it at the first level (at 5 strata, fewer than 90
good documents tested) gets no rule, and so loses no document to it.

Everything is built-in functions. Repeated windows are found by 64-bit hashes.

Defined results: a null text has no words and fails the base rule; null languages are
a stratum of their own; documents without a label take the stratum's cutoffs, those
of a stratum without labels only the base rule; a document with several labels counts
with each; repeated rows are judged alike; an empty labels table gives no cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowharbor.llm.tables import settled

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
GRID = 40
#: One in so many good documents lays out the levels.
DESIGN = 5
#: Usual values are read from so many bins of a ratio; spreads are at least LEAST_SPREAD.
BINS = 1000
LEAST_SPREAD = 0.01
#: Spreads above the usual value, from what no ratio exceeds down to one.
LEVELS = tuple((1 / LEAST_SPREAD) ** (1 - k / (GRID - 1)) for k in range(GRID))
MAX_FALSE = 0.05
CONFIDENCE = 0.95
NO_STRATUM = "(null)"
#: The cutoffs table has one row for each stratum; up to so many are broadcast.
BROADCAST_STRATA = 10_000

#: rule name -> ratio of counts in [0, 1], the larger the worse
RULES = {
    "symbols": "least(n_symbols / greatest(word_chars, 1), 1)",
    "capitals": "least(n_capitals / greatest(word_chars, 1), 1)",
    "marks": "least(n_marks / greatest(n_words, 1), 1)",
    "repeats": "least(n_repeat_words / greatest(n_words, 1), 1)",
    "lines": "least(n_dup_lines / greatest(n_lines, 1), 1)",
    "long_words": "least(word_chars / greatest(n_words, 1) / 20, 1)",
}


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, not wherever it is named."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur at least twice among ``words``."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def counted(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - window)
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(h, i + 1, window)))
        return F.when(F.size(h) <= window, F.lit(0)).otherwise(
            _let(windows, lambda w: _covered(w, window))
        )

    return _let(hashes, counted)


def _covered(windows: Column, window: int) -> Column:
    """Places within ``window`` of the start of a repeated value."""
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        _let(_repeated(windows), lambda starts: _reach(starts, window))
    )


def _repeated(windows: Column) -> Column:
    """Places of the values that occur more than once, in order: after sorting, a
    repeated value equals one of its neighbours."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def neighbours(p: Column) -> Column:
        values = F.transform(p, lambda x: x.h)
        after = F.concat(F.slice(values, 2, F.size(p)), F.array(F.lit(None).cast("long")))
        before = F.concat(F.array(F.lit(None).cast("long")), values)
        marked = F.zip_with(
            p, after, lambda x, y: F.struct(x.i.alias("i"), x.h.alias("h"), x.h.eqNullSafe(y).alias("again"))
        )
        both = F.zip_with(
            marked, F.slice(before, 1, F.size(p)), lambda x, y: F.struct(x.i.alias("i"), (x.again | x.h.eqNullSafe(y)).alias("again"))
        )
        return F.array_sort(F.transform(F.filter(both, lambda x: x.again), lambda x: x.i))

    return _let(pairs, neighbours)


def _reach(starts: Column, window: int) -> Column:
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
        lambda acc, i: F.struct(
            (acc.n + F.least(F.lit(window), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc.n,
    )


def measured(docs: DataFrame, *, doc_id: str, text: str, stratum: str) -> DataFrame:
    """The counts of every text."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(stratum).cast("string"), F.lit(NO_STRATUM)).alias("stratum"),
        body.alias("body"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(body, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    return words.select(
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        _without(F.col("body"), BLANKS).cast("long").alias("word_chars"),
        (F.char_length("body") - _without(F.col("body"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        (F.char_length("body") - _without(F.col("body"), CAPITALS)).cast("long").alias("n_capitals"),
        (F.char_length("body") - _without(F.col("body"), "!?")).cast("long").alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    )


def binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) for X ~ Binomial(n, p): its terms, in logarithms, one by one."""
    first = n * F.log1p(-p)
    odds = F.log(p) - F.log1p(-p)
    summed = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))),
        F.struct(first.cast("double").alias("term"), first.cast("double").alias("sum")),
        lambda acc, i: _add_term(acc, F.when(i <= k, acc.term + F.log((n - i + 1) / i) + odds)),
        lambda acc: acc["sum"],
    )
    return F.when(k >= n, F.lit(1.0)).otherwise(F.least(F.exp(summed), F.lit(1.0)))


def _add_term(acc: Column, term: Column) -> Column:
    top = F.greatest(acc["sum"], term)
    both = top + F.log(F.exp(acc["sum"] - top) + F.exp(term - top))
    return F.struct(
        F.coalesce(term, acc.term).alias("term"),
        F.when(term.isNull(), acc["sum"]).otherwise(both).alias("sum"),
    )


def _usual(design: DataFrame) -> DataFrame:
    """stratum, usual: by rule, the median ratio and how far the upper tenth is from it."""
    ratios = F.explode(
        F.create_map(*[x for name, ratio in RULES.items() for x in (F.lit(name), F.expr(ratio).cast("double"))])
    ).alias("rule", "ratio")
    bins = F.ceil(F.col("ratio") * BINS).cast("int")
    histogram = design.select("stratum", ratios).groupBy("stratum", "rule", bins.alias("bin")).agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("stratum", "rule")  # at most BINS + 1 rows each
    shares = histogram.select("stratum", "rule", "bin", (F.sum("n").over(up_to.orderBy("bin")) / F.sum("n").over(up_to)).alias("share"))
    found = shares.groupBy("stratum", "rule").agg(
        F.min(F.when(F.col("share") >= 0.5, F.col("bin"))).alias("half"), F.min(F.when(F.col("share") >= 0.9, F.col("bin"))).alias("most")
    )
    spread = F.greatest((F.col("most") - F.col("half")) / BINS, F.lit(LEAST_SPREAD))
    entry = F.struct("rule", F.struct((F.col("half") / BINS).alias("median"), spread.alias("spread")))
    return found.groupBy("stratum").agg(F.map_from_entries(F.collect_list(entry)).alias("usual"))


def _cutoff(rule: str | Column, level: Column) -> Column:
    usual = F.element_at("usual", F.lit(rule) if isinstance(rule, str) else rule)
    return usual["median"] + usual["spread"] * F.element_at(F.array(*[F.lit(x) for x in LEVELS]), level + 1)


def cutoffs(good: DataFrame, *, max_false: float, confidence: float) -> DataFrame:
    """stratum, rule, cutoff: the tightest level at which all rules together are safe.

    ``good`` has the counts of the holdout's good documents. False rejections are counted
    from one histogram of the level at which a document first fails (stratum x level).
    """
    designing = F.pmod(F.xxhash64(F.lit("levels"), "doc_id"), F.lit(DESIGN)) == 0
    usual = settled(_usual(good.where(designing)))
    few = F.broadcast if usual.count() <= BROADCAST_STRATA else lambda df: df
    held = good.where(~designing).join(few(usual), "stratum")

    def passes(level: Column) -> Column:
        kept = F.lit(True)
        for name in RULES:
            kept &= F.col(name) <= _cutoff(name, level)
        return kept

    ratios = held.select("stratum", "usual", *[F.expr(ratio).cast("double").alias(name) for name, ratio in RULES.items()])
    levels = F.sequence(F.lit(0), F.lit(GRID - 1))
    first = F.size(F.filter(levels, passes)).alias("first")  # levels are nested
    histogram = ratios.select("stratum", first).groupBy("stratum", "first").agg(F.count("*").alias("n"))
    per_stratum = histogram.groupBy("stratum").agg(
        F.sum("n").alias("n_good"), F.map_from_entries(F.collect_list(F.struct("first", "n"))).alias("firsts")
    )
    failing = F.aggregate(
        F.map_entries(F.map_filter("firsts", lambda f, _: f <= F.col("level"))),
        F.lit(0).cast("long"),
        lambda total, e: total + e.value,
    )
    strata = per_stratum.agg(F.count("*").alias("n_strata"))
    risk = F.lit(float(max_false))
    refuted = (F.col("n_false") < F.col("n_good") * risk) & (
        binomial_tail(F.col("n_false"), F.col("n_good"), risk) * F.col("n_strata") <= 1 - confidence
    )
    chosen = (
        per_stratum.crossJoin(F.broadcast(strata))  # one number
        .select("*", F.explode(levels).alias("level"))
        .withColumn("n_false", failing)
        .groupBy("stratum")
        .agg((F.coalesce(F.min(F.when(~refuted, F.col("level"))), F.lit(GRID)) - 1).alias("level"))
        .where("level >= 0")
    )
    rules = F.explode(F.array(*[F.lit(name) for name in RULES])).alias("rule")
    return chosen.join(few(usual), "stratum").select("stratum", "usual", "level", rules).select(
        "stratum", "rule", _cutoff(F.col("rule"), F.col("level")).alias("cutoff")
    )


def judged(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    max_false: float = MAX_FALSE,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Counts, base_failed, failed_rules and kept of every document."""
    rows = settled(measured(docs, doc_id=doc_id, text=text, stratum=stratum))
    good = labels.where(F.col(label) == 1).select(F.col("doc_id"))
    holdout = rows.where(~base_failed()).join(good, "doc_id")
    found = cutoffs(holdout, max_false=max_false, confidence=confidence)
    per_stratum = settled(
        found.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    )
    few = F.broadcast if per_stratum.count() <= BROADCAST_STRATA else lambda df: df
    failed = F.array_compact(
        F.array(
            *[
                F.when(F.expr(ratio).cast("double") > F.element_at("cutoffs", name), F.lit(name))
                for name, ratio in RULES.items()
            ]
        )
    )
    return rows.join(few(per_stratum), "stratum", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & (F.size(F.coalesce(failed, F.array().cast("array<string>"))) == 0)).alias("kept"),
        failed.alias("failed_rules"),
    )
