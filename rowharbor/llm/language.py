"""Language identification: known words first, then ever shorter n-grams.

A known word is scored by its log frequency in each language. A word the model has
not seen is scored by its longest known character n-grams: those of four letters,
and only if none of them is known those of three, and so on. A text's language is
the one with the greatest sum over its words.

The model is fitted on a bounded sample of labelled texts: about
``texts_per_language`` of each language, whole texts, drawn by a hash. Of each
language at most ``words_per_language`` words and ``ngrams_per_language`` n-grams
of each length are kept, the most frequent ones. All languages are learned; with very
many of them each has fewer words and n-grams, so that ``model_entries`` bounds what is
sent to the executors.

Defined results: a null text or one without a letter is ``und`` with score 0; with
no labelled text at all everything is ``und``; null languages teach nothing; equal
scores go to the language first in alphabetical order; repeated rows are answered
alike.
"""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowharbor.llm.scan import mix, ranges, span_hashes, spans, text_column, text_slices
from rowharbor.llm.tables import settled, with_own_columns

UNKNOWN = "und"
NGRAMS = (4, 3, 2, 1)
#: Languages' shares are broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_LANGUAGES = 500_000
SMOOTHING = 0.5


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _characters(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of lower-cased code points with their offsets per text."""
    lowered = pc.utf8_lower(texts)
    lengths = pc.fill_null(pc.utf8_length(lowered), 0).to_numpy(zero_copy_only=False)
    for row, end, data, _ in text_slices(lowered):
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        yield row, end, points, np.concatenate([[0], np.cumsum(lengths[row:end])])


def _point_values(points: np.ndarray) -> np.ndarray:
    return (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def _word_counts(text: str, lang: str):
    """Counts of (language, word) within each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(batch.schema.get_field_index(lang)).to_pylist()
            counts: dict[str, Counter] = defaultdict(Counter)
            for row, _, points, offsets in _characters(text_column(batch, text)):
                starts, ends = spans(_letters()[points], offsets)
                owner = np.searchsorted(offsets, starts, side="right") - 1
                whole = points.tobytes().decode("utf-32-le")
                for k, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist()):
                    counts[langs[row + k]][whole[a:b]] += 1
            rows = [(l, w, n) for l, words in counts.items() for w, n in words.items()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                ["lang", "word", "n"],
            )

    return run


class Table:
    """Log frequencies of hashed keys by language, without those of the keys that a
    language lacks: all these have the language's ``base``. Its size is that of what was
    learned, however many languages there are."""

    def __init__(self, counts: list[dict[int, int]]):
        """``counts``: of each language, in order."""
        sizes = [len(c) for c in counts]
        keys = np.concatenate([np.fromiter(c, np.uint64, len(c)) for c in counts] or [np.zeros(0, np.uint64)])
        values = np.concatenate([np.fromiter(c.values(), float, len(c)) for c in counts] or [np.zeros(0)])
        owner = np.repeat(np.arange(len(counts)), sizes)
        order = np.lexsort((owner, keys))
        self.keys, first = np.unique(keys[order], return_index=True)
        self.begin = np.append(first, len(keys))
        self.language = owner[order].astype(np.int32)
        self.more = np.log((values[order] + SMOOTHING) / SMOOTHING).astype(np.float32)
        totals = np.bincount(owner, values, minlength=len(counts)) + SMOOTHING * len(self.keys)
        self.base = np.log(SMOOTHING / totals) if len(self.keys) else np.zeros(len(counts))

    def add(self, scores: np.ndarray, rows: np.ndarray, weights: np.ndarray, texts: np.ndarray) -> None:
        """Add the weighted log frequencies of some keys to their texts' scores."""
        n_texts, n_languages = scores.shape
        scores += np.bincount(texts, weights, minlength=n_texts)[:, None] * self.base
        count = self.begin[rows + 1] - self.begin[rows]
        at = ranges(self.begin[rows], count)
        cell = np.repeat(texts, count) * n_languages + self.language[at]
        scores += np.bincount(
            cell, np.repeat(weights, count) * self.more[at], minlength=n_texts * n_languages
        ).reshape(n_texts, n_languages)


def _hash_words(words: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = ends - np.array([len(w) for w in words], np.int64)
    return span_hashes(_point_values(points), starts, ends)


class Model:
    """Log frequencies of words and n-grams per language."""

    def __init__(self, words: dict[str, Counter], ngrams_per_language: int):
        self.languages = sorted(words)
        hashed, grams = [], {n: [] for n in NGRAMS}
        for l in self.languages:
            hashed.append(dict(zip(_hash_words(list(words[l])).tolist(), words[l].values(), strict=True)))
            for n in NGRAMS:
                own: Counter = Counter()
                for w, count in words[l].items():
                    for k in range(len(w) - n + 1):
                        own[w[k : k + n]] += count
                top = sorted(own.items(), key=lambda g: (-g[1], g[0]))[:ngrams_per_language]
                hashes = _gram_hashes([g for g, _ in top], n)
                grams[n].append(dict(zip(hashes.tolist(), (c for _, c in top), strict=True)))
        self.words = Table(hashed)
        self.grams = {n: Table(counts) for n, counts in grams.items()}

    def score(self, points: np.ndarray, offsets: np.ndarray):
        """Per text: number of words, and summed scores by language."""
        starts, ends = spans(_letters()[points], offsets)
        values = _point_values(points)
        text = np.searchsorted(offsets, starts, side="right") - 1
        scores = np.zeros((len(offsets) - 1, len(self.languages)))
        word_rows = _lookup(self.words.keys, span_hashes(values, starts, ends))
        known = word_rows >= 0
        self.words.add(scores, word_rows[known], np.ones(known.sum()), text[known])
        open_ = np.flatnonzero(~known)
        for n in NGRAMS:
            table = self.grams[n]
            count = np.maximum(ends[open_] - starts[open_] - n + 1, 0)
            at = ranges(starts[open_], count)
            rows = _lookup(table.keys, _gram_values(values, at, n))
            word = np.repeat(np.arange(len(open_)), count)[rows >= 0]
            found = np.bincount(word, minlength=len(open_))
            # a word counts once, by the mean of its known n-grams
            table.add(scores, rows[rows >= 0], 1 / found[word], text[open_[word]])
            open_ = open_[found == 0]
        return np.diff(np.searchsorted(starts, offsets)), scores


def _gram_values(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    hashed = np.full(len(at), n, np.uint64)
    for k in range(n):
        hashed = hashed * np.uint64(0x5851F42D4C957F2D) + values[at + k]
    return mix(hashed)


def _gram_hashes(grams: list[str], n: int) -> np.ndarray:
    points = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32)
    return _gram_values(_point_values(points), np.arange(len(grams)) * n, n)


def _lookup(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


def fit(
    labelled: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    texts_per_language: int = 2000,
    words_per_language: int = 20_000,
    ngrams_per_language: int = 20_000,
    model_entries: int = 8_000_000,
) -> Model:
    """A model of the labelled texts, of all their languages. ``doc_id`` only draws the
    sample. A language has at most ``words_per_language`` words and
    ``ngrams_per_language`` n-grams of each length; with very many languages each has
    fewer, so that the model has at most some ``model_entries`` (12 bytes each)."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
        F.pmod(F.xxhash64(F.col(doc_id), F.lit("language")), F.lit(1_000_000)).alias("draw"),
    )
    per = settled(rows.groupBy("lang").agg(F.count("*").alias("n")))
    n_languages = per.count()
    if not n_languages:
        return Model({}, ngrams_per_language)
    each = max(1, model_entries // (n_languages * (1 + len(NGRAMS))))
    words_per_language, ngrams_per_language = min(words_per_language, each), min(ngrams_per_language, each)
    shares = per.select("lang", F.ceil(F.lit(1_000_000 * texts_per_language) / F.col("n")).alias("share"))
    few = n_languages <= BROADCAST_LANGUAGES
    sample = rows.join(F.broadcast(shares) if few else shares, "lang").where("draw < share").select("text", "lang")
    counts = (
        sample.mapInArrow(_word_counts("text", "lang"), "lang string, word string, n bigint")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("place", place).where(F.col("place") <= words_per_language)
    words: dict[str, Counter] = defaultdict(Counter)
    for r in top.select("lang", "word", "n").collect():
        words[r.lang][r.word] = r.n
    return Model(words, ngrams_per_language)


def _predict_batches(model, text: str, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = model.value
        names = np.array([*fitted.languages, UNKNOWN], object)
        for batch in batches:
            best = np.full(batch.num_rows, len(names) - 1)
            score = np.zeros(batch.num_rows)
            if fitted.languages:
                for row, end, points, offsets in _characters(text_column(batch, text)):
                    n, sums = fitted.score(points, offsets)
                    # words are not independent, so evidence grows as their root
                    logits = sums / np.sqrt(np.maximum(n, 1))[:, None]
                    shares = np.exp(logits - logits.max(axis=1, keepdims=True))
                    shares /= shares.sum(axis=1, keepdims=True)
                    top = shares.argmax(axis=1)
                    best[row:end] = np.where(n > 0, top, len(names) - 1)
                    score[row:end] = np.where(n > 0, shares.max(axis=1), 0.0)
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in carried}
            columns["lang_pred"] = pa.array(names[best].tolist(), pa.string())
            columns["score"] = pa.array(score)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def identify(
    docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (or only the columns ``keep``) with lang_pred and score (0 to 1).

    Columns of ``docs`` named lang_pred or score are replaced.
    """
    rows = docs.drop("lang_pred", "score")
    carried = rows.columns if keep is None else keep
    fields = [f for c in carried for f in rows.schema if f.name == c]
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    schema = ", ".join([*names, "lang_pred string", "score double"])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    wanted = list(dict.fromkeys([*carried, text]))
    return rows.select(*wanted).mapInArrow(_predict_batches(sent, text, carried), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the documents no model may learn from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2


def recognised(docs: DataFrame, model: Model, min_score: float = 0.5, *, text: str = "text") -> DataFrame:
    """The documents whose language is known with a score of at least ``min_score``, with
    their own columns."""
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)
    return with_own_columns(docs, lambda own, names: identify(own, model, text=names[text]).where(known))
