"""A bidirectional LSTM in numpy that tells main text from the rest of a page.

It reads a page's blocks as one sequence; a block is the bag of its tag path (tags,
words of class and id) and of all its hashed words, with a few measures. Two LSTMs read
the page from either end, so every block is judged by the whole page.

It is trained here: on pages laid out by ``drawn_page``, whose labels are known, with
the words of a bounded sample of real pages, and on those sampled pages that mark
their article themselves.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np

from rowharbor.llm.blocks import Block, leaf_blocks

PATH_SLOTS, WORD_SLOTS, MEASURES = 512, 64, 6
INPUTS = PATH_SLOTS + WORD_SLOTS + MEASURES
HIDDEN = 16

# Names that web pages give to their parts.
OTHER_PARTS = {
    "menu": "nav div.menu ul.nav div#navigation div.navbar div.breadcrumb nav.main-menu div.topnav",
    "header": "header div#header div.site-header div.masthead div.top-bar div.logo div.tagline",
    "sidebar": "aside div.sidebar div#sidebar div.widget div.related div.recommended div.trending aside.sidebar div.right-column",
    "notice": "div.cookie-notice div.cookie-banner div.gdpr div.notice div.alert div.newsletter div.popup div.modal div.consent div#cookies section.notice",
    "advert": "div.ad div.ads div.advert div.advertisement div.sponsored div.banner div.promo ins.adsbygoogle aside.ad",
    "form": "form div.search form.login form.subscribe div.signup form#search",
    "comments": "section#comments div.comments div.comment ol.comment-list div.comment-body div.disqus div#respond section.reader-comments div.replies ul.comments div.user-comments",
    "footer": "footer div.footer div#footer div.copyright div.site-footer div.social div.share div.legal",
}
ARTICLES = "article main main/article div.content div#content div.post div.entry-content div.article-body section.story div#main article.post div.text main/div.content article/div.body section div"
INNER_PARTS = ("advert", "comments", "menu", "form", "sidebar")


@lru_cache(maxsize=1 << 16)
def _path_slots(path: tuple[str, ...]) -> np.ndarray:
    own = [f"last:{path[-1]}"] if path else []
    return np.unique([zlib.crc32(p.encode()) % PATH_SLOTS for p in (*path, *own)]).astype(int)


def features(blocks: list[Block]) -> np.ndarray:
    out = np.zeros((len(blocks), INPUTS), np.float32)
    for k, b in enumerate(blocks):
        out[k, _path_slots(b.path)] = 1
        words = b.text.lower().encode().split(b" ")
        slots = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % WORD_SLOTS
        out[k, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = np.bincount(slots, minlength=WORD_SLOTS) * (0.5 / len(words))
        n = len(b.text)
        out[k, PATH_SLOTS + WORD_SLOTS :] = (
            math.log1p(n) / 8,
            b.linked,
            b.text.count(" ") / (n + 1) * 4,
            b.text[-1] in ".!?\"'”»…",
            k / len(blocks),
            1.0,
        )
    return out


def _tag(name: str, body: str) -> str:
    for part in reversed(name.split("/")):
        for sign, attribute in ((".", "class"), ("#", "id")):
            if sign in part:
                tag, value = part.split(sign)
                body = f'<{tag} {attribute}="{value}">{body}</{tag}>'
                break
        else:
            body = f"<{part}>{body}</{part}>"
    return body


def drawn_page(rng: np.random.Generator, words: list[str]) -> str:
    """A page of random layout; main text carries the mark \\x01 in every block."""

    def some(low: int, high: int, mark: str = "") -> str:
        return mark + " ".join(words[k] for k in rng.integers(0, len(words), rng.integers(low, high)))

    def part(kind: str) -> str:
        name = str(rng.choice(OTHER_PARTS[kind].split()))
        if kind in ("menu", "footer", "sidebar") and rng.random() < 0.7:
            body = "<ul>" + "".join(f'<li><a href="/x">{some(1, 4)}</a></li>' for _ in range(rng.integers(2, 8))) + "</ul>"
            body += f"<p>{some(3, 20)}</p>" if rng.random() < 0.4 else ""
        elif kind == "form":
            body = f'<label>{some(1, 4)}</label><input name="q"><select><option>{some(1, 3)}</option></select><button>{some(1, 3)}</button>'
        elif kind == "comments":
            body = f"<h3>{some(1, 3)}</h3>" * int(rng.random() < 0.5)
            body += "".join(
                _tag(str(rng.choice(["p", "div.comment", "li", "div.comment/p"])), some(4, 40))
                for _ in range(rng.integers(1, 5))
            )
        else:
            inner = str(rng.choice(["p", "div", "span", "h2", "h3/a", ""]))
            body = _tag(inner, some(2, 30)) if inner else some(2, 30)
            body += f"<p>{some(5, 40)}</p>" if rng.random() < 0.3 else ""
            body += f'<p class="ad">{some(1, 8)}<br>{some(1, 8)}</p>' if kind == "advert" and rng.random() < 0.2 else ""
        return _tag(name, body)

    main = [f"<h1>{some(3, 12, chr(1))}</h1>"]
    if rng.random() < 0.2:
        main[0] = f"<header>{main[0]}</header>"
    for _ in range(rng.integers(1, 12)):
        kind = rng.random()
        if kind < 0.08:
            inner = str(rng.choice(["<br>", "<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", '<img src="x">', "<svg></svg>"]))
            mark = "" if inner[1] in "mi" else chr(1)
            main.append(f"<p>{some(1, 60, chr(1))} {inner}{some(1, 40, mark)}</p>")
        elif kind < 0.1:
            main.append(_tag(str(rng.choice(["noscript/p", "object/p", "noscript", "object"])), some(3, 60, chr(1))))
        elif kind < 0.7:
            main.append(f"<p>{some(1, 90, chr(1))}</p>")
        elif kind < 0.78:
            main.append(_tag(str(rng.choice(["h2", "h3"])), some(1, 8, chr(1))))
        elif kind < 0.86:
            items = "".join(f"<li>{some(2, 20, chr(1))}</li>" for _ in range(rng.integers(2, 6)))
            main.append(_tag(str(rng.choice(["ul", "ol"])), items))
        elif kind < 0.95:
            main.append(_tag(str(rng.choice(["blockquote/p", "pre", "table/tr/td", "figure/figcaption", "blockquote", "div", "p/b", "section/p"])), some(3, 40, chr(1))))
        else:
            main.append(f'<p>{some(1, 20, chr(1))} <a href="/x">{some(1, 4)}</a> {some(1, 20)}</p>')
    if rng.random() < 0.45:
        main.insert(int(rng.integers(1, len(main) + 1)), part(str(rng.choice(INNER_PARTS))))
    article = _tag(str(rng.choice(ARTICLES.split())), "".join(main))
    before = [part(str(k)) for k in rng.choice(["menu", "header", "notice", "advert", "form"], rng.integers(0, 4))]
    after = [part(str(k)) for k in rng.choice(["comments", "footer", "sidebar", "advert", "notice", "menu", "form"], rng.integers(0, 4))]
    opened = "</head><body>" if rng.random() < 0.9 else ""
    return f"<html><head><title>{some(1, 6)}</title>{opened}{''.join(before)}{article}{''.join(after)}</body></html>"


_NOT_MAIN = {"nav", "aside", "footer", "form", "button", "select", ".ad", ".ads", ".comments", ".comment"}


def sample_examples(pages: list[str], n_drawn: int, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences of drawn pages and of pages that mark their article."""
    rng = np.random.default_rng(seed)
    examples, words = [], []
    for html in pages:
        blocks = leaf_blocks(html)
        words += [w for b in blocks[:200] for w in b.text.split(" ", 60)[:60]]
        if any("article" in b.path or "main" in b.path for b in blocks):
            y = [("article" in b.path or "main" in b.path) and not _NOT_MAIN & set(b.path) for b in blocks]
            examples.append((features(blocks), np.array(y, np.float32)))
    words = words[:50_000] or ["a", "b", "the", "of."]
    for _ in range(n_drawn):
        blocks = leaf_blocks(drawn_page(rng, words))
        y = np.array(["\x01" in b.text for b in blocks], np.float32)
        for b in blocks:
            b.text = b.text.replace("\x01", "") or "-"
        examples.append((features(blocks), y))
    return [e for e in examples if len(e[1])]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Weights of two LSTMs, of their output and of a direct path from the input."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.15).astype(np.float32)
        self.weights = {
            "xf": small(INPUTS, 4 * HIDDEN),
            "hf": small(HIDDEN, 4 * HIDDEN),
            "xb": small(INPUTS, 4 * HIDDEN),
            "hb": small(HIDDEN, 4 * HIDDEN),
            "out": small(2 * HIDDEN, 1),
            "direct": np.zeros((INPUTS, 1), np.float32),
        }

    def _read(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool):
        """One LSTM over (pages, blocks, inputs), from the end if ``way`` is b."""
        w = self.weights
        pages, steps, _ = x.shape
        gates = (x.reshape(-1, INPUTS) @ w["x" + way]).reshape(pages, steps, -1)
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((pages, steps, HIDDEN), np.float32)
        trace = []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            a = gates[:, t] + h @ w["h" + way]
            i, f, o = (_sigmoid(a[:, k * HIDDEN : (k + 1) * HIDDEN] + (k == 1)) for k in range(3))
            g = np.tanh(a[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new_c = np.where(m, f * c + i * g, c)
            tanh_c = np.tanh(new_c)
            new_h = np.where(m, o * tanh_c, h)
            if keep:
                trace.append((t, h, c, i, f, o, g, tanh_c))
            h, c = new_h, new_c
            out[:, t] = h
        return out, trace

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        forth, _ = self._read(x, mask, "f", False)
        back, _ = self._read(x, mask, "b", False)
        return (np.concatenate([forth, back], axis=2) @ self.weights["out"] + x @ self.weights["direct"])[..., 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        reads = {way: self._read(x, mask, way, True) for way in "fb"}
        both = np.concatenate([reads["f"][0], reads["b"][0]], axis=2)
        p = _sigmoid((both @ w["out"] + x @ w["direct"])[..., 0])
        d = ((p - y) * mask / mask.sum())[..., None].astype(np.float32)
        flat = x.reshape(-1, INPUTS)
        found = {"out": both.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, 1), "direct": flat.T @ d.reshape(-1, 1)}
        dboth = d @ w["out"].T
        for n, way in enumerate("fb"):
            dout = dboth[:, :, n * HIDDEN : (n + 1) * HIDDEN]
            da_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh_weights = np.zeros_like(w["h" + way])
            dh = np.zeros((len(x), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, tanh_c in reversed(reads[way][1]):
                m = mask[:, t, None]
                dh = dh + dout[:, t]
                dcell = dc + dh * o * (1 - tanh_c**2)
                da = np.concatenate(
                    [dcell * g * i * (1 - i), dcell * c * f * (1 - f), dh * tanh_c * o * (1 - o), dcell * i * (1 - g**2)], axis=1
                ) * m
                da_all[:, t] = da
                dh_weights += h.T @ da
                dh = np.where(m, da @ w["h" + way].T, dh)
                dc = np.where(m, dcell * f, dc)
            found["h" + way] = dh_weights
            found["x" + way] = flat.T @ da_all.reshape(-1, 4 * HIDDEN)
        return found

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray]], rounds: int = 10, seed: int = 3, at_once: int = 16) -> "Labeller":
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(examples))
            for at in range(0, len(order), at_once):
                x, mask, y = padded([examples[k] for k in order[at : at + at_once]])
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    rate = 0.01 * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.weights[k] = self.weights[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
        return self


def padded(examples: list[tuple[np.ndarray, np.ndarray]], most: int = 200):
    """Sequences side by side; in training long pages are read in part."""
    steps = min(max(len(y) for _, y in examples), most)
    x = np.zeros((len(examples), steps, INPUTS), np.float32)
    y = np.zeros((len(examples), steps), np.float32)
    mask = np.zeros((len(examples), steps), bool)
    for k, (own, label) in enumerate(examples):
        n = min(len(label), steps)
        x[k, :n], y[k, :n], mask[k, :n] = own[:n], label[:n], True
    return x, mask, y
