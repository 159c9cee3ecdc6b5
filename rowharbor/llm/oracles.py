"""SQL that gives the rows of the queries which SQL can express."""

from __future__ import annotations

_WHOLE = """
        whole AS MATERIALIZED (
            SELECT vec_id, label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


# Words: runs of digits, letters (A-Z as a-z) and characters beyond ASCII.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}')"


#: Every 50-byte string of every document, as hexadecimal text.
_REPEATS = """
        WITH bytes AS MATERIALIZED (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
            FROM documents),
        windows AS (
            SELECT doc_id, unnest(range(greatest(n - 49, 0))) AS i, h FROM bytes),
        hashed AS MATERIALIZED (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS w FROM windows),
        least AS (SELECT w, min(doc_id) AS first FROM hashed GROUP BY w),
        covered AS (
            SELECT h.doc_id, h.i, lag(h.i) OVER (PARTITION BY h.doc_id ORDER BY h.i) AS before
            FROM hashed h JOIN least l ON h.w = l.w AND h.doc_id > l.first),
        numbered AS (
            SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END)
                       OVER (PARTITION BY doc_id ORDER BY i) AS run
            FROM covered),
        runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
        gaps AS (
            SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS open FROM runs),
        kept AS (
            SELECT g.doc_id, sum(g.b - g.a) AS n_removed, count(*) AS n_spans, max(g.b) AS last,
                   string_agg(substr(x.h, 2 * g.open + 1, 2 * (g.a - g.open)), '' ORDER BY g.a) AS h
            FROM gaps g JOIN bytes x ON g.doc_id = x.doc_id GROUP BY g.doc_id)
        SELECT x.doc_id, x.n AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(k.n_spans, 0) AS n_spans,
               sha256(unhex(CASE WHEN k.doc_id IS NULL THEN x.h
                   ELSE concat(k.h, substr(x.h, 2 * k.last + 1)) END)) AS kept_sha256
        FROM bytes x LEFT JOIN kept k ON x.doc_id = k.doc_id
    """

_CONTAMINATION = f"""
        WITH d AS MATERIALIZED (SELECT doc_id, {_words('text')} AS ws FROM documents),
        items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words('text')} AS ws FROM benchmark),
        spans AS (
            SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(len(ws) - least(len(ws), 10) + 1)) AS i
            FROM items WHERE len(ws) > 0),
        windows AS MATERIALIZED (
            SELECT DISTINCT item_id, n, array_to_string(ws[i + 1 : i + n], ' ') AS w FROM spans),
        lengths AS (SELECT DISTINCT n FROM windows),
        places AS (
            SELECT doc_id, ws, n, unnest(range(greatest(len(ws) - n + 1, 0))) AS i FROM d, lengths),
        hits AS MATERIALIZED (
            SELECT p.doc_id, p.i, p.n, w.item_id
            FROM places p JOIN windows w ON p.n = w.n AND array_to_string(p.ws[p.i + 1 : p.i + p.n], ' ') = w.w),
        words AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, i + unnest(range(n)) AS place FROM hits) GROUP BY doc_id),
        ids AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
            FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, len(d.ws) AS n_words, coalesce(words.n_hit, 0) AS n_hit,
               coalesce(ids.n_items, 0) AS n_items, sha256(coalesce(ids.listed, '')) AS items_sha256,
               words.n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN ids ON d.doc_id = ids.doc_id
    """

_NEAR = f"""
        WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, text, {_words('text')} AS ws FROM documents),
        shingled AS (
            SELECT doc_id, CASE
                WHEN len(ws) >= 5 THEN list_sort(list_distinct(list_transform(
                    range(len(ws) - 4), lambda i: array_to_string(ws[i + 1 : i + 5], ' '))))
                WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')]
                WHEN text <> '' THEN [text] END AS s
            FROM d),
        named AS MATERIALIZED (SELECT doc_id, s, md5(array_to_string(s, '|')) AS name FROM shingled),
        sets AS MATERIALIZED (
            SELECT name, min(doc_id) AS rep, count(*) AS copies, any_value(s) AS s
            FROM named WHERE s IS NOT NULL GROUP BY name),
        members AS MATERIALIZED (SELECT name, len(s) AS n, unnest(s) AS shingle FROM sets),
        shared AS (
            SELECT a.name AS u, b.name AS v, count(*) AS k, any_value(a.n) AS n, any_value(b.n) AS m
            FROM members a JOIN members b ON a.shingle = b.shingle AND a.name <> b.name GROUP BY a.name, b.name),
        links AS MATERIALIZED (SELECT u, v FROM shared WHERE 5 * k >= 4 * (n + m - k)),
        reached(node, root) AS (
            SELECT name, name FROM sets UNION SELECT l.v, r.root FROM reached r JOIN links l ON r.node = l.u),
        classes AS (
            SELECT r.node, min(s.rep) AS class_id FROM reached r JOIN sets s ON r.root = s.name GROUP BY r.node),
        counted AS (
            SELECT l.u, count(*) AS n_texts, sum(s.copies) AS n_links
            FROM links l JOIN sets s ON l.v = s.name GROUP BY l.u)
        SELECT n.doc_id, coalesce(c.class_id, n.doc_id) AS class_id,
               CAST(coalesce(k.n_links, 0) + coalesce(s.copies - 1, 0) AS BIGINT) AS n_links,
               coalesce(k.n_texts, 0) AS n_texts
        FROM named n LEFT JOIN sets s ON n.name = s.name LEFT JOIN classes c ON n.name = c.node
        LEFT JOIN counted k ON n.name = k.u
    """


def _codes(rounds: int) -> str:
    """SQL of ``op13_vector_codes``: every part against every entry, round by round."""
    distance = " + ".join(f"(p.x[{i}] - b.x[{i}]) * (p.x[{i}] - b.x[{i}])" for i in range(1, 5))
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        held{r} AS MATERIALIZED (
            SELECT p.vec_id, p.part, min(({distance}) * 64 + b.entry) AS best
            FROM parts p JOIN book{r} b ON p.part = b.part GROUP BY p.vec_id, p.part)""")
        if r < rounds:
            mean = ", ".join(f"CAST(floor(sum(p.x[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))
            steps.append(f"""
        moved{r} AS (
            SELECT p.part, h.best % 64 AS entry, [{mean}] AS x
            FROM parts p JOIN held{r} h ON p.vec_id = h.vec_id AND p.part = h.part GROUP BY 1, 2),
        book{r + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
            FROM book{r} b LEFT JOIN moved{r} m ON b.part = m.part AND b.entry = m.entry)""")
    return f"""
        WITH {_WHOLE},
        parts AS MATERIALIZED (
            SELECT vec_id, g.part, v[4 * g.part + 1 : 4 * g.part + 4] AS x
            FROM whole, (SELECT unnest(range(16)) AS part) g),
        first_ids AS (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry
            FROM whole ORDER BY vec_id LIMIT 64),
        book0 AS MATERIALIZED (
            SELECT p.part, f.entry, p.x FROM parts p JOIN first_ids f ON p.vec_id = f.vec_id),
        {",".join(steps)},
        sums AS (
            SELECT vec_id, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code,
                   CAST(sum(best // 64) AS BIGINT) AS error
            FROM held{rounds} GROUP BY vec_id),
        books AS (
            SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
            FROM book{rounds})
        SELECT s.vec_id, s.code, s.error,
               CAST(sum(s.error) OVER (PARTITION BY w.label) AS BIGINT) AS label_error,
               books.codebooks_sha256
        FROM sums s JOIN whole w ON s.vec_id = w.vec_id, books
    """


ORACLES: dict[str, str] = {
    "op1_repeats": _REPEATS,
    "op6_contamination": _CONTAMINATION,
    "op9_jaccard_join": _NEAR,
    "op8_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first FROM p
              WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
    """,
    "op13_vector_codes": _codes(rounds=2),
    "op12_hard_negatives": f"""
        WITH {_WHOLE},
        kept AS MATERIALIZED (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v
            FROM whole WHERE label IS NOT NULL),
        scored AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
                   CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
            FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               row_number() OVER (
                   PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank,
               n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.alike
        WHERE 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
        QUALIFY rank <= 3
    """,
}
