"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowharbor.llm.tables import settled


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the least of u and all its neighbours. The least are settled, so
    that the join has shuffles of its own and the pairs of a hot node are split."""
    least = settled(pairs.groupBy("u").agg(F.min("v").alias("m")))
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node under the node's least neighbour."""
    pairs = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(pairs).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours under the least of these."""
    down = _with_least(edges)
    moved = down.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(down.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; ``edges`` has (u, v), u != v.

    Alternating stars: the number of rounds grows with the logarithm of the nodes.
    Each round is written to the shared folder, so a lost executor costs one round.
    """
    current = settled(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while True:
        # a star forest stays as it is: every node's edge leads to its root
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        current = settled(_small_star(_large_star(current)))
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(current.select("v", "v").distinct())
