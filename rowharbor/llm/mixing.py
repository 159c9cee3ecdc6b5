"""Mixing sources to target weights by hierarchical budgets.

Sources form a tree of three levels: domain, language, source. A token budget goes
down the tree by weight. No subtree can take more than its tokens times the epochs
allowed; what a child cannot take goes to its siblings by their weights, and only
what all of them cannot take reaches the siblings of their parent. This is one
water level for each parent: x_i = min(capacity_i, level * weight_i), found exactly
in whole tokens from the running sums over children in the order of
capacity / weight.

A leaf then reads its documents in seeded epochs, each a permutation of its own,
until its budget is reached: all whole epochs, and of the next one the documents up
to and including the one that reaches the budget. The running sums of a leaf are
taken within hash ranges of the permutation and offset by the sums of the ranges
before, so a leaf with a third of all rows is not the work of one task.

Defined results: null domain, language or source form groups of their own, named
``(null)``; a text without a token (or null) takes no budget and is chosen with the
whole epochs only; a weight of 0 gets nothing; if the budget exceeds all capacity
every document is read ``max_epochs`` times; repeated rows count as rows; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowharbor.llm.tables import settled

NO_NAME = "(null)"
RANGE_ROWS = 4_096
#: Budgets of up to so many leaves are broadcast (under 200 bytes each).
BROADCAST_LEAVES = 100_000
LEVELS = ("domain", "lang", "source")


def tokens_of(text: Column) -> Column:
    """Words between blanks."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def poured(children: DataFrame, parent: list[str], budgets: DataFrame | None, total: int) -> DataFrame:
    """``children`` (parent columns, child columns, weight, capacity) with ``budget``.

    Children are filled in the order of capacity / weight; while the level of the
    rest is above a child's capacity it is full. The rest of the budget is divided
    by weight in whole tokens, cumulatively, so that nothing is lost to rounding.
    """
    if budgets is None:
        rows = children.withColumn("given", F.lit(total).cast("long"))
    else:
        rows = children.join(budgets.withColumnRenamed("budget", "given"), parent)
    own = [c for c in children.columns if c not in (*parent, "weight", "capacity")]
    # capacity / weight in exact arithmetic; a weight of 0 never takes part
    ratio = F.when(F.col("weight") > 0, F.col("capacity").cast("decimal(20,0)") * 1_000_000 / F.col("weight"))
    keys = parent or [F.lit(1)]
    order = Window.partitionBy(*keys).orderBy(F.col("ratio").asc_nulls_last(), *own)
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    rows = (
        rows.withColumn("ratio", ratio)
        .withColumn("full", F.coalesce(F.sum("capacity").over(past), F.lit(0)))
        .withColumn("used", F.coalesce(F.sum("weight").over(past), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(whole))
        # all children before this one are full: would it be full as well?
        .withColumn(
            "is_full",
            (F.col("weight") > 0)
            & (
                F.col("capacity") * (F.col("weights") - F.col("used"))
                <= (F.col("given") - F.col("full")) * F.col("weight")
            ),
        )
    )
    rest = F.col("given") - F.sum(F.when(F.col("is_full"), F.col("capacity")).otherwise(0)).over(whole)
    open_weight = F.when(F.col("is_full"), 0).otherwise(F.col("weight"))
    rows = rows.withColumn("rest", rest).withColumn("open", open_weight)
    rows = rows.withColumn("all_open", F.sum("open").over(whole)).withColumn(
        "open_to", F.sum("open").over(order)
    )

    share = F.expr("(rest * open_to) div all_open - (rest * (open_to - open)) div all_open")
    budget = F.when(F.col("is_full"), F.col("capacity")).when(F.col("all_open") > 0, F.least(share, F.col("capacity"))).otherwise(0)
    return rows.select(*parent, *own, budget.cast("long").alias("budget"))


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], budget: int, max_epochs: int) -> DataFrame:
    """Tokens for each leaf (domain, lang, source, tokens)."""

    def weight(level: str) -> Column:
        found = F.lit(weights.get(level, {}).get("*", 1))
        for name, w in weights.get(level, {}).items():
            if name != "*":
                found = F.when(F.col(level) == name, w).otherwise(found)
        return found.cast("long")

    capacity = (F.sum("tokens") * max_epochs).cast("long").alias("capacity")
    given = None
    for depth, level in enumerate(LEVELS):
        children = leaves.groupBy(*LEVELS[: depth + 1]).agg(capacity).withColumn("weight", weight(level))
        given = poured(children, list(LEVELS[:depth]), given, budget)
    return given


def mixture(
    docs: DataFrame,
    weights: dict[str, dict[str, int]],
    *,
    domain: Column,
    share: float = 0.5,
    max_epochs: int = 3,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    row_key: Column | None = None,
) -> DataFrame:
    """doc_id, domain, lang, source, tokens, leaf_budget, copies of every document.

    ``weights`` gives whole-number weights by level and name (``*`` for the others).
    The budget is ``share`` of all tokens; ``copies`` is how often a document is read.
    ``row_key`` is passed through.
    """
    name = lambda c: F.coalesce(c.cast("string"), F.lit(NO_NAME))
    order = F.md5(F.concat_ws("|", F.lit(seed), name(F.col(doc_id)), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
    own_key = [] if row_key is None else [row_key.alias("row_key")]
    rows = settled(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            name(domain).alias("domain"),
            name(F.col(lang)).alias("lang"),
            name(F.col(source)).alias("source"),
            tokens_of(F.col(text)).alias("tokens"),
            order.alias("order"),
            *own_key,
        )
    )
    leaves = settled(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_docs")))
    total = leaves.select(F.sum("tokens"), F.max("n_docs"), F.count("*")).first()
    budget = int((total[0] or 0) * share)
    ranges = max(1, -(-(total[1] or 0) // RANGE_ROWS))
    budgets = leaf_budgets(leaves, weights, budget, max_epochs).join(leaves, list(LEVELS))
    plan = settled(
        budgets.select(
            *LEVELS,
            F.col("budget").alias("leaf_budget"),
            F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("epochs"),
            F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("open_tokens"),
        )
    )
    few = F.broadcast if total[2] <= BROADCAST_LEAVES else lambda df: df
    joined = rows.join(few(plan), list(LEVELS))
    # the permutation of the epoch that is not whole: another order for each epoch
    joined = joined.withColumn("order", F.md5(F.concat_ws("|", "order", "epochs")))
    part = F.floor(F.conv(F.substring("order", 1, 7), 16, 10).cast("long") * ranges / (1 << 28))
    joined = joined.withColumn("part", part.cast("int"))
    past = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        joined.groupBy(*LEVELS, "part")
        .agg(F.sum("tokens").alias("n"))
        .select(*LEVELS, "part", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("begin"))
    )
    within = Window.partitionBy(*LEVELS, "part").orderBy("order", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = joined.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    reached = (F.col("tokens") > 0) & (F.col("begin") + F.col("inside") < F.col("open_tokens"))
    return placed.join(begins, [*LEVELS, "part"]).select(
        "doc_id",
        *LEVELS,
        "tokens",
        "leaf_budget",
        (F.col("epochs") + reached.cast("int")).cast("int").alias("copies"),
        *[F.col("row_key") for _ in own_key],
    )


def mixed(docs: DataFrame, weights: dict[str, dict[str, int]], *, domain: Column, **options) -> DataFrame:
    """The documents of the mixture, each as often as it is read, with their columns.

    Rows of one id and text are chosen by their tokens together: such rows all stay
    if one of them is chosen.
    """
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    key = F.xxhash64(F.col(doc_id), F.col(text))
    chosen = (
        mixture(docs, weights, domain=domain, row_key=key, **options)
        .where("copies > 0")
        .groupBy("row_key")
        .agg(F.max("copies").alias("copies"))
    )
    # the documents as one column: theirs may have any name
    return (
        docs.select(F.struct("*").alias("document"), key.alias("own_key"))
        .join(chosen, F.col("own_key") == F.col("row_key"))
        .select("document", F.explode(F.sequence(F.lit(1), "copies")))
        .select("document.*")
    )
