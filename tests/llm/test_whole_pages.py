"""Blocks of pages are read whole: all words, all texts, with the tags they stand in."""

import numpy as np

from rowharbor.llm.blocks import Block, leaf_blocks
from rowharbor.llm.labeller import PATH_SLOTS, WORD_SLOTS, features


def test_all_words_of_a_block_are_hashed():
    same = " ".join(f"w{k}" for k in range(40))
    texts = [f"{same} reply thanks", f"{same} market report"]
    a, b = features([Block(t, ("p",), 0.0) for t in texts])[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS]
    assert not np.array_equal(a, b)
    assert np.allclose([a.sum(), b.sum()], 0.5)


def blocks(html):
    return [(b.text, b.path) for b in leaf_blocks(html)]


def test_line_breaks_and_void_tags_stay_in_their_paragraph():
    path = ("article", "p", ".ad")
    assert blocks('<article><p class="ad">Buy<br>now</p>then</article>') == [("Buy", path), ("now", path), ("then", ("article",))]
    assert blocks('<article><p class="ad">Buy <img src="x"> it <input>now<p>b</article>') == [("Buy it now", path), ("b", ("article", "p"))]
    assert blocks("<p>a<button>b<div>c</div></button>d<div>e</div>")[-2:] == [("d", ("p",)), ("e", ("div",))]


def test_a_head_ends_without_its_end_tag():
    assert blocks("<html><head><title>t</title><p>text") == [("text", ("html", "p"))]
    assert blocks("<html><head><title>t</title>text<p>more") == [("text", ("html",)), ("more", ("html", "p"))]
    assert blocks("<head><title>t</title><style>x</style><template><p>no</p></template></head><body>b") == [("b", ("body",))]


def test_text_in_formulas_and_fallbacks_is_kept():
    html = "<article><p>so <math><mi>x</mi><mo>=</mo><annotation>\\x</annotation></math> holds</p><noscript><p>plain</p></noscript><object>other</object><svg><text>label</text></svg></article>"
    assert [t for t, _ in blocks(html)] == ["so x= holds", "plain", "other", "label"]
