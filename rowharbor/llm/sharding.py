"""K-d tree shards: weighted median splits along the widest metadata dimension.

The root holds all rows. A node that is to become several shards looks for the
dimension along which its rows spread widest, weighted by bytes, and is cut there so
that both sides get bytes in proportion to the shards they are to become; with N
shards the leaves reach 1/N of all bytes. Dimensions are in order: the logarithm of the
size, and names by alphabet, each at the share of all bytes that the names before it
have. Spread is variance over the square of the dimension's range at the root, so that
unlike dimensions compare. Rows of equal value are ordered by their
text, then by their row key, so that equal texts stay in one shard unless their
group is so large that shards of near equal size must divide it.

No node is sorted. A median is found by histograms of ``BINS`` bins, all nodes of a
level at once: of the dimension, of the text hash within the value of the median,
and, if one text is heavier than a cut may miss, of the row key within that text. Only histograms and the splits (one less
than the shards) reach the driver, whatever the number of rows.

Shards follow the law ``bytes``: their sizes are near equal.

Defined results: a null text weighs 8 bytes like an empty one; null metadata are
lowest; repeated rows (same id and text) go together or next to each other; with
fewer rows than shards some shards stay empty; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowharbor.llm.tables import settled
from rowharbor.operators.numbering import with_running

BINS = 2048
ROW_OVERHEAD = 8
#: A group of equal texts up to this share of a shard is never divided by a cut,
#: and a histogram bin up to this share is not looked into.
WHOLE_GROUP = 0.1
CLOSE_ENOUGH = 0.001
#: Keys have 32 bits; three histograms find one value.
KEY_SCALES = (1 << 21, 1 << 10, 1)
SLOT_ROWS = 5_000
#: Places of names are broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_NAMES = 200_000


@dataclass(frozen=True)
class Node:
    """A node that is to become the shards ``first`` to ``end`` - 1."""

    first: int
    end: int


def _lookup(values: dict[int, int], default: int) -> Column:
    """The value of a row's node; a node is named by its first shard."""
    if not values:
        return F.lit(default).cast("long")
    pairs = [F.lit(x).cast("long") for item in sorted(values.items()) for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("node")), F.lit(default))


def _cut(histogram: list[tuple[int, int]], wanted: float) -> tuple[int, int, int]:
    """The bin the wanted weight falls in, the weight before it and its own."""
    before = 0
    for key, weight in histogram:
        if before + weight > wanted:
            return key, before, weight
        before += weight
    return histogram[-1][0] + 1, before, 0


def _histograms(rows: DataFrame, key: Column) -> dict[int, list[tuple[int, int]]]:
    """Bytes by bin for each node: at most BINS rows for each."""
    found = rows.groupBy("node", key.cast("long").alias("key")).agg(F.sum("size").alias("size"))
    out: dict[int, list[tuple[int, int]]] = {}
    for r in found.collect():
        out.setdefault(r.node, []).append((r.key, r.size))
    return {k: sorted(v) for k, v in out.items()}


def _split_level(rows: DataFrame, nodes: list[Node], widths: list[float], shard_bytes: float):
    """Cuts every node that is to become more than one shard; ``widths`` are the ranges of
    the dimensions at the root."""
    n_dimensions = len(widths)
    measures = [F.sum("size").alias("size")]
    for d in range(n_dimensions):
        at = F.col("at")[d]
        measures.append(F.sum(at * F.col("size")).alias(f"sum_{d}"))
        measures.append(F.sum(at.cast("double") * at * F.col("size")).alias(f"square_{d}"))
    stats = {r.node: r for r in rows.groupBy("node").agg(*measures).collect()}
    chosen: dict[int, int] = {}
    wanted: dict[int, float] = {}
    for node in nodes:
        if node.first not in stats or node.end - node.first < 2:
            continue
        s = stats[node.first]
        spread = [
            (s[f"square_{d}"] / s["size"] - (s[f"sum_{d}"] / s["size"]) ** 2) / widths[d] ** 2
            for d in range(n_dimensions)
        ]
        chosen[node.first] = max(range(n_dimensions), key=lambda d: (spread[d], d))
        wanted[node.first] = s["size"] * ((node.end - node.first) // 2) / (node.end - node.first)
    if not chosen:
        return rows, nodes
    rows = rows.withColumn("value", F.col("at")[_lookup(chosen, 0).cast("int")])
    inside = rows.where(F.col("node").isin(list(chosen)))
    # dimensions are ranks of at most BINS steps, so a bin is one value
    value_at: dict[int, int] = {}
    for k, histogram in _histograms(inside, F.col("value")).items():
        value_at[k], before, _ = _cut(histogram, wanted[k])
        wanted[k] -= before
    inside = inside.where(F.col("value") == _lookup(value_at, -1))
    cuts: dict[str, dict[int, int]] = {"text_key": {}, "row_key": {}}
    todo = set(chosen)
    for key_name, found in cuts.items():
        for scale in KEY_SCALES:
            if not todo:
                break
            for k in todo:
                found.setdefault(k, 0)
            offset = F.col(key_name) - _lookup({k: found[k] for k in todo}, 1 << 33)
            part = inside.where((offset >= 0) & (offset < scale * BINS))
            for k, histogram in _histograms(part, F.floor(offset / scale)).items():
                key, before, weight = _cut(histogram, wanted[k])
                wanted[k] -= before
                found[k] += key * scale
                group = scale == 1 and key_name == "text_key"
                row = scale == 1 and key_name == "row_key"
                if row or weight <= shard_bytes * (WHOLE_GROUP if group else CLOSE_ENOUGH):
                    # too small to cut: it goes whole to the nearer side
                    found[k] += scale if wanted[k] > weight / 2 else 0
                    todo.discard(k)
        inside = inside.where(F.col(key_name) == _lookup({k: found[k] for k in todo}, -1))
    value, text, row = F.col("value"), F.col("text_key"), F.col("row_key")
    value_cut, text_cut = _lookup(value_at, 0), _lookup(cuts["text_key"], 0)
    before = (value < value_cut) | (
        (value == value_cut)
        & ((text < text_cut) | ((text == text_cut) & (row < _lookup(cuts["row_key"], 0))))
    )
    middles = {n.first: n.first + (n.end - n.first) // 2 for n in nodes if n.first in chosen}
    moved = F.when(F.col("node").isin(list(chosen)) & ~before, _lookup(middles, 0)).otherwise(F.col("node"))
    split = []
    for n in nodes:
        if n.first in chosen:
            split += [Node(n.first, middles[n.first]), Node(middles[n.first], n.end)]
        else:
            split.append(n)
    return settled(rows.withColumn("node", moved).drop("value")), split


def _with_places(rows: DataFrame, name: str, total: int) -> DataFrame:
    """Rows with the place of their name, 0 to BINS - 1: the share of all bytes that the
    names before it have. Names are summed up over ranges of the alphabet."""
    names = rows.groupBy(name).agg(F.sum("size").alias("bytes"))
    running = with_running(names, [], [name], {"before": F.col("bytes")})
    place = F.floor(F.col("before") * F.lit(float(BINS)) / F.lit(max(total, 1)))
    places = settled(running.select(F.col(name).alias("known"), F.least(place, F.lit(BINS - 1)).cast("long").alias("place")))
    few = places.count() <= BROADCAST_NAMES
    return rows.join(F.broadcast(places) if few else places, F.col(name) == F.col("known")).drop(name, "known").withColumnRenamed("place", name)


def _log_rank(value: Column, scale: float) -> Column:
    return F.least(F.round(F.log2(F.coalesce(value, F.lit(0)) + 1) * scale), F.lit(BINS - 1)).cast("long")


def shards(
    docs: DataFrame,
    n_shards: int = 24,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    names: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    Dimensions are the size of the text and the columns in ``names``. Rows of equal
    text are taken at the metadata of the least of them, hence at one place.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    present = [c for c in names if c in docs.columns]
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("text_hash"),
        # null and empty names are lowest
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"of_{c}") for c in present],
    )
    rows = settled(rows)
    total = rows.select(F.sum("size")).first()[0] or 0
    for c in present:
        rows = _with_places(rows, f"of_{c}", total)
    rows = settled(rows)
    group = ["text_crc32", "text_hash", "size"]
    least = rows.groupBy(*group).agg(*[F.min(f"of_{c}").alias(f"at_{c}") for c in present], F.count("*").alias("copies"))
    # settled, so that the join has shuffles of its own and a hot text's rows are split
    least = settled(least.where("copies > 1").drop("copies"))
    rows = rows.join(least, group, "left").select(
        "doc_id",
        "size",
        "text_crc32",
        F.array(_log_rank(F.col("size"), 64.0), *[F.coalesce(f"at_{c}", f"of_{c}") for c in present]).alias("at"),
        F.pmod(F.xxhash64("text_hash", "text_crc32"), F.lit(1 << 32)).alias("text_key"),
        F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 32)).alias("row_key"),
        F.lit(0).cast("long").alias("node"),
    )
    rows = settled(rows)
    places = [F.col("at")[d] for d in range(1 + len(present))]
    ranges = rows.agg(*[(F.max(at) - F.min(at)).cast("double") for at in places]).first()
    widths = [float(r or 0) or 1.0 for r in ranges]
    nodes = [Node(0, n_shards)]
    for _ in range(max(n_shards - 1, 0).bit_length()):
        rows, nodes = _split_level(rows, nodes, widths, total / n_shards)
    placed = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("node").cast("int").alias("shard"),
        "row_key",
    )
    return slotted(placed).withColumn("grown_shard", F.lit(None).cast("int"))


def slotted(placed: DataFrame) -> DataFrame:
    """A gapless ``slot`` from 0 in each shard: rows are numbered within ranges of
    their key, and each range begins where those before it end, so no shard is
    numbered by one task."""
    counts = placed.groupBy("shard").agg(F.count("*").alias("n"))
    most = counts.select(F.max("n")).first()[0] or 0
    parts = max(1, -(-most // SLOT_ROWS))
    part = F.floor(F.col("row_key") * parts / (1 << 32)).cast("int")
    rows = placed.withColumn("part", part)
    order = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        rows.groupBy("shard", "part")
        .agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("begin"))
    )
    within = Window.partitionBy("shard", "part").orderBy("row_key", "doc_id", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(within))
        .join(begins, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "law",
            "shard",
            (F.col("begin") + F.col("place") - 1).cast("long").alias("slot"),
        )
    )
