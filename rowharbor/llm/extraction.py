"""Main text of web pages by a recurrent block labeller.

A page is parsed into leaf blocks; a bidirectional LSTM labels each of them with the
whole page in view; the blocks labelled as main text are joined. The labeller is
fitted on a bounded sample of ``sample_pages`` pages, drawn by a hash of the address
(pages of more than ``SAMPLE_BYTES`` are not drawn), and on as many drawn layouts.

Defined results: a null or empty html, or one without text, has an empty text;
character references are decoded; markup that never ends is read as far as it goes;
repeated rows are answered alike; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowharbor.llm.blocks import leaf_blocks
from rowharbor.llm.labeller import INPUTS, Labeller, features, sample_examples
from rowharbor.llm.scan import text_column

SAMPLE_BYTES = 64 << 10
CELLS_AT_ONCE = 8192


def fit(pages: DataFrame, *, url: str = "url", html: str = "html", sample_pages: int = 300, n_drawn: int = 500) -> Labeller:
    rows = pages.where(F.octet_length(html) <= SAMPLE_BYTES)
    n = rows.count()
    share = min(1_000_000, -(-1_000_000 * sample_pages // max(n, 1)))
    drawn = rows.where(F.pmod(F.xxhash64(url, html), F.lit(1_000_000)) < share).select(html)
    # some pages more or fewer than sample_pages, never more than twice as many
    sample = sorted(r[0] for r in drawn.limit(2 * sample_pages).collect())
    return Labeller().fit(sample_examples(sample, n_drawn))


def _labels(labeller: Labeller, sequences: list[np.ndarray]) -> list[np.ndarray]:
    """Which blocks are main text, pages of like length side by side."""
    order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(sequences)
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * len(sequences[order[to]]) <= CELLS_AT_ONCE:
            to += 1
        steps = len(sequences[order[to - 1]])
        x = np.zeros((to - at, steps, INPUTS), np.float32)
        mask = np.zeros((to - at, steps), bool)
        for k, own in enumerate(order[at:to]):
            x[k, : len(sequences[own])] = sequences[own]
            mask[k, : len(sequences[own])] = True
        found = labeller.logits(x, mask) > 0 if steps else mask
        for k, own in enumerate(order[at:to]):
            out[own] = found[k, : len(sequences[own])]
        at = to
    return out


def _extract_batches(model, html: str, carried: list[str], pages_at_once: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            column = text_column(batch, html)
            for at in range(0, batch.num_rows, pages_at_once):
                parsed = [leaf_blocks(h) for h in column[at : at + pages_at_once].to_pylist()]
                labels = _labels(model.value, [features(b) for b in parsed])
                for blocks, main in zip(parsed, labels):
                    texts.append(" ".join(b.text for b, m in zip(blocks, main) if m))
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in carried}
            columns["text"] = pa.array(texts, pa.string())
            columns["n_chars"] = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def main_text(pages: DataFrame, labeller: Labeller, *, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every page with its main ``text`` and ``n_chars``."""
    fields = [f for c in keep for f in pages.schema if f.name == c]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "text string, n_chars bigint"])
    sent = pages.sparkSession.sparkContext.broadcast(labeller)
    return pages.select(*keep, html).mapInArrow(_extract_batches(sent, html, list(keep)), schema)
