"""Operators on small tables against brute force, and the awkward cases: nulls,
empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rowharbor.llm import (
    components,
    contamination,
    extraction,
    language,
    licences,
    mixing,
    quality,
    repeats,
    sharding,
    similarity,
    warc,
)
from rowharbor.llm.labeller import Labeller, sample_examples

WORDS = [a + b for a in "ba ce di fo gu ha ki lo mu ne".split() for b in "n r st l m".split()]
DOCS = "doc_id bigint, text string, lang string, source string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(30, 120)) for _ in range(40)]
    passage = prose(rng, 14)
    texts += [texts[0], texts[0], texts[1] + " tail", f"{prose(rng, 20)} {passage} {prose(rng, 9)}"]
    texts += [f"{passage}\n{prose(rng, 30)}", texts[2].replace(" ", "  ", 3), "word", "&&& ###", "", None]
    texts += [prose(rng, 6000), "aaaa" * 300, "aaaa" * 280]
    out = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}" if i % 5 else None) for i, t in enumerate(texts)]
    return [*out, out[3], (None, texts[5], None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    clashing = {c: F.lit("x") for c in ("n_words", "score", "matches", "block", "size", "key", "digit", "tokens")}
    return spark.createDataFrame(rows, DOCS).withColumns(clashing).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def low_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_repeats(docs, rows, none):
    last = (1 << 63) - 1
    first = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, last), last if i is None else i)
    want = collections.Counter()
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (last if i is None else i):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        want[(i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    for hot in (4000, 1):  # the second takes every run apart at once
        repeats.HOT_DOCUMENTS, before = hot, repeats.HOT_DOCUMENTS
        found = repeats.without_repeats(docs, block_bytes=4000)
        got = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        repeats.HOT_DOCUMENTS = before
        assert collections.Counter(tuple(r) for r in got) == want
    assert repeats.without_repeats(none).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_contamination(spark, docs, rows, none, block):
    opening = " ".join(rows[0][1].split()[:25])
    items = [(1, rows[43][1]), (2, "word"), (3, None), (4, ""), (5, opening), (5, opening), (None, rows[1][1])]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = low_words(t)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    want = collections.Counter()
    for i, t, *_ in rows:
        w, ids = low_words(t), set()
        hit = [False] * len(w)
        for k in range(len(w)):
            for n in range(1, 11):
                own = windows.get(tuple(w[k : k + n])) if k + n <= len(w) else None
                if own:
                    ids |= own - {None}
                    hit[k : k + n] = [True] * n
        joined = ",".join(sorted(map(str, ids)))
        want[(i, len(w), sum(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), any(hit))] += 1
    found = contamination.contaminated(contamination.contamination(docs, table, block_bytes=block))
    got = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert collections.Counter(tuple(r) for r in got) == want
    longest = [r["matches"] for r in found.where("doc_id = 0").collect()][0]
    assert {m["item_id"] for m in longest} == {"5"} and max(m["n_words"] for m in longest) == len(low_words(items[4][1]))
    kept = contamination.uncontaminated(docs, table, block_bytes=block)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[-1])
    assert contamination.contamination(docs, table.limit(0)).where("n_hit > 0").count() == 0
    assert contamination.contamination(none, table).count() == 0


def test_near_duplicates(docs, rows, none):
    sets = {}
    for i, t, *_ in rows:
        w = low_words(t)
        if i is not None:
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else ({t} if t else set())
    ids = [i for i, *_ in rows if i is not None]
    links, root = collections.Counter(), {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                links[ids[a]] += 1
                links[ids[b]] += ids[a] != ids[b]
                low, high = sorted((find(ids[a]), find(ids[b])))
                root[high] = low
    for size in (1024, 2):
        similarity.BLOCK, before = size, similarity.BLOCK
        got = similarity.near_duplicates(docs).collect()
        similarity.BLOCK = before
        assert {(r.doc_id, r.class_id, r.n_links) for r in got if r.doc_id is not None} == {
            (i, find(i), links[i]) for i in sets
        }
        assert len(got) == len(rows)
    kept = similarity.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.where("doc_id is not null").select("doc_id").collect()) == sorted({find(i) for i in sets})
    assert kept.where("doc_id is null").count() == 1
    assert similarity.near_duplicates(none).count() == 0 and similarity.one_of_each(none).count() == 0


def test_language(spark, none):
    rng = random.Random(2)
    own = {l: [a + b for a in s.split() for b in "en er on".split()] for l, s in {"xx": "ba be bi bo", "yy": "za ze zi zo"}.items()}
    rows = [(i, " ".join(rng.choice(own[l]) for _ in range(30)), l, None) for i in range(80) for l in own]
    train = spark.createDataFrame(rows, DOCS)
    model = language.fit(train)
    cases = [(1, "baener bionon", None, None), (2, "ZAERZI", None, None), (3, "12 & !", None, None), (4, None, None, None), (5, "", None, None), (5, "", None, None)]
    got = language.identify(spark.createDataFrame(cases, DOCS).withColumn("score", F.lit("x")), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in sorted(got, key=lambda r: r.doc_id)] == [(1, "xx"), (2, "yy"), (3, "und"), (4, "und"), (5, "und"), (5, "und")]
    assert all(0 <= r.score <= 1 for r in got)
    empty = language.fit(none)
    assert {r.lang_pred for r in language.identify(train, empty).collect()} == {"und"}
    assert language.identify(none, model).count() == 0 and language.recognised(train, model).count() == 160
    out = [r[0] for r in spark.range(50).withColumnRenamed("id", "doc_id").where(language.held_out()).collect()]
    assert out == [i for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2]


def test_shards(docs, rows, none):
    got = sharding.shards(docs, 5).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(0 <= r.shard < 5 and r.grown_shard is None for r in got)
    texts = {(r[0]): r[1] or "" for r in rows}
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
    assert sharding.shards(none).count() == 0


def test_shards_are_near_equal_with_a_hot_text(spark):
    rng = random.Random(3)
    rows = [(i, "same text" * 9 if i % 3 == 0 else prose(rng, rng.randint(5, 40)), "en", f"s{i % 7}") for i in range(6000)]
    got = sharding.shards(spark.createDataFrame(rows, DOCS), 24).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    sizes = [r.n for r in got]
    assert len(sizes) == 24 and max(sizes) < 1.1 * sum(sizes) / 24 and min(sizes) > 0.9 * sum(sizes) / 24


def test_mixture(docs, rows, none):
    weights = {"domain": {"a": 3, "b": 1}, "lang": {"de": 2, "*": 1}}
    domain = F.when(F.col("source") == "src1", "a").otherwise("b")
    for share, epochs in ((0.4, 3), (0.9, 1), (5.0, 2)):
        got = mixing.mixture(docs, weights, domain=domain, share=share, max_epochs=epochs).collect()
        assert len(got) == len(rows)
        leaves = collections.defaultdict(list)
        for r in got:
            leaves[(r.domain, r.lang, r.source)].append(r)
        total = sum(r.tokens for r in got)
        given = 0
        for own in leaves.values():
            budget, read = own[0].leaf_budget, sum(r.tokens * r.copies for r in own)
            given += budget
            assert budget <= read < budget + max(r.tokens for r in own) + 1
            assert budget <= epochs * sum(r.tokens for r in own)
        assert given == min(int(total * share), epochs * total)
    assert mixing.mixture(none, weights, domain=domain).count() == 0
    kept = mixing.mixed(docs, weights, domain=domain, share=1.0, max_epochs=1)
    assert kept.columns == docs.columns


def test_water_level(spark):
    children = spark.createDataFrame([("a", 1, 10), ("b", 1, 100), ("c", 2, 100), ("d", 0, 50)], "name string, weight bigint, capacity bigint")
    got = {r.name: r.budget for r in mixing.poured(children, [], None, 100).collect()}
    assert got == {"a": 10, "b": 30, "c": 60, "d": 0}


def test_quality(spark, docs, rows, none):
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, quality int")
    got = {(r.doc_id, r.n_words): r for r in quality.judged(docs, labels).collect()}
    for i, t, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        counts = collections.Counter(windows)
        again = [False] * len(words)
        for k, w in enumerate(windows):
            if counts[w] > 1:
                again[k : k + 8] = [True] * 8
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[(i, len(words))]
        assert (r.word_chars, r.n_dup_lines, r.n_repeat_words) == (sum(map(len, words)), len(lines) - len(set(lines)), sum(again))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t or ""))
        assert r.base_failed == (len(words) < 20 or 100 * sum(again) > 30 * len(words)) and (r.kept <= (not r.base_failed))
    assert quality.judged(none, labels).count() == 0
    assert quality.judged(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_cutoffs_hold_on_good_documents(spark):
    rows = [(i, ("&&& " if i % 10 == 0 else "") * 30 + prose(random.Random(i), 40), "en", None) for i in range(3000)]
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(3000)], "doc_id bigint, quality int")
    got = quality.judged(spark.createDataFrame(rows, DOCS), labels).join(labels, "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.05 * 2700 and counts.get((0, True), 0) == 0


def test_binomial_tail(spark):
    import math

    cases = [(0, 10, 0.1), (3, 10, 0.3), (10, 10, 0.2), (5, 2000, 0.01)]
    rows = spark.createDataFrame(cases, "k bigint, n bigint, p double")
    got = [r[0] for r in rows.select(quality.binomial_tail(F.col("k"), F.col("n"), F.col("p"))).collect()]
    want = [sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) for k, n, p in cases]
    assert got == pytest.approx(want)


def test_warc(spark, tmp_path):
    page = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 40
    rows = [(1, "http://a/\n", page), (2, None, page), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", "x" * 5000), (6, "u", "x" * 5000), (None, "u", page), (7, "u", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("x"))
    path = str(tmp_path / "a")
    warc.write_archives(pages, path, chunk_bytes=333, archive_bytes=700)
    got = warc.read_records(spark, path).collect()
    assert len(got) == len(rows)
    want = collections.Counter(
        (i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if i in (2, None) else "response", 1 if i in (2, None) else None)
        for i, _, h in rows
    )
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert max(r.n_chunks for r in got) == -(-5000 // 333)
    warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_records(spark, str(tmp_path / "b")).count() == 0


def test_html(spark):
    labeller = Labeller().fit(sample_examples([], 400))
    html = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<div class='cookie-notice'><p>We use cookies</p></div><article><h1>A &amp; B</h1><p>One <b>two</b>three\n four</p>"
        "<script>var x='<p>no</p>'</script><ul><li>Item one here</li></ul></article>"
        "<section class='comments'><p>Nice post, thanks</p></section><form><label>Name</label></form><footer>Copyright</footer></body></html>"
    )
    rows = [(1, "u", html), (2, None, None), (3, "u", ""), (4, "u", "<p"), (1, "u", html)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = [(r.page_id, r.text, r.n_chars) for r in extraction.main_text(pages, labeller).collect()]
    text = "A & B One twothree four Item one here"
    assert got[0] == got[4] == (1, text, len(text)) and got[1][1] == got[2][1] == ""
    held = sample_examples([], 100, seed=77)
    labels = extraction._labels(labeller, [x for x, _ in held])
    assert sum((l == (y > 0)).all() for l, (_, y) in zip(labels, held)) >= 90
    assert extraction.main_text(pages.limit(0), labeller).count() == 0
    assert extraction.fit(pages.limit(0)) is not None


def test_licences(spark, docs, rows, none):
    model = licences.fit(docs)
    cases = [(1, "prose\nReleased under the MIT License.", "MIT"), (2, "Licensed under the Apache License, Version 2.0.\nx", "Apache"), (3, "He lost his driving licence.", "unknown"), (4, None, None), (5, "nothing", None)]
    got = licences.scanned(spark.createDataFrame([(i, t, None, None) for i, t, _ in cases], DOCS), model).collect()
    assert {r.doc_id: r.family for r in got} == {i: f for i, _, f in cases}
    assert {r.doc_id for r in got if r.confirmed} == {1, 2}
    assert licences.scanned(docs, model).count() == len(rows) and licences.scanned(none, model).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 1), (7, 9), (2, 1)]
    got = components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert sorted((r.node, r.root) for r in got) == [(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7), (9, 7), (20, 1)]
