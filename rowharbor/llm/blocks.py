"""Leaf blocks of HTML pages, in page order, with the tags they stand in.

A page is read once from its start to its end; the time is in proportion to its length,
whatever its markup: what never ends (a comment, a value, a script) ends with the page,
and no tag looks through those that are open.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from dataclasses import dataclass

# Tags without content, tags whose text is never page text (annotations are
# the source of a formula, beside it), and tags that stand inside a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head title script style template iframe annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark math q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr area base col embed img input link meta param source track".split()
)
# Start tags that close an open <p>, tags that keep it from them, and what can
# stand in a head.
CLOSES_P = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary table ul xmp "
    "td th tr tbody thead tfoot caption".split()
)
KEEPS_P = frozenset("applet button caption marquee object table td template th svg math".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
# Tags whose content is text up to their own end tag.
RAW = frozenset("script style title textarea".split())
_NAME = re.compile(r"[a-z]+")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(\"|'|[^\s>\"'][^\s>]*)?)?")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}
#: Of a deeper path, and of more names of a tag, half is the outermost and half the
#: innermost.
MOST_TAGS = 128
MOST_NAMES = 64


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: float


class _Reader:
    def __init__(self):
        self.blocks: list[Block] = []
        self.tags: list[str] = []
        self.marks: list[tuple[str, ...]] = []
        #: where each open tag stands among the open tags
        self.at: defaultdict[str, list[int]] = defaultdict(list)
        self.silent = 0
        self.pieces: list[str] = []
        self.linked = 0
        self.path: tuple[str, ...] = ()

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(Block(text, self.path, self.linked / len(text)))
            self.pieces, self.linked = [], 0

    def push(self, tag: str, mark: tuple[str, ...]) -> None:
        self.at[tag].append(len(self.tags))
        self.tags.append(tag)
        self.marks.append(mark)
        self.silent += tag in SILENT

    def pop(self, to: int) -> None:
        for tag in self.tags[to:]:
            self.silent -= tag in SILENT
            self.at[tag].pop()
        del self.tags[to:], self.marks[to:]

    def last(self, tag: str) -> int:
        """Where the innermost open tag of a name stands, -1 if none is open."""
        places = self.at.get(tag)
        return places[-1] if places else -1

    def end_head(self) -> None:
        if self.at.get("head") and self.last("template") < 0:
            self.pop(self.at["head"][0])

    def start(self, tag: str, names: list[str]) -> None:
        if tag not in IN_HEAD:
            self.end_head()
        if tag not in INLINE and self.last("math") < 0:
            self.end_block()
            open_p = self.last("p")
            if tag in CLOSES_P and open_p >= 0 and all(self.last(t) < open_p for t in KEEPS_P):
                self.pop(open_p)
            closed = CLOSES.get(tag)
            if closed and self.tags:
                inner = len(self.tags) - 1
                at = max((self.last(t) for t in closed), default=-1)
                # only tags inside a line may stand between
                if 0 <= at and inner - at <= MOST_TAGS and all(t in INLINE for t in self.tags[at + 1 :]):
                    while at >= 0 and self.tags[at] in closed:
                        self.pop(at)
                        at -= 1
        if tag in VOID:
            return
        if tag == "body":
            self.pop(0)
        self.push(tag, (tag, *names))

    def end(self, tag: str) -> None:
        if tag not in INLINE and self.last("math") < 0:
            self.end_block()
        if (at := self.last(tag)) >= 0:
            self.pop(at)

    def text(self, data: str) -> None:
        if self.tags and self.tags[-1] in ("head", "noscript") and data.strip():
            self.end_head()
        if self.silent:
            return
        if not self.pieces:
            if not data.strip():
                return
            half = MOST_TAGS // 2
            marks = self.marks if len(self.marks) <= MOST_TAGS else self.marks[:half] + self.marks[-half:]
            self.path = tuple(m for mark in marks for m in mark)
        self.pieces.append(data)
        if self.at.get("a"):
            self.linked += len(data.strip())


def _names(attributes: list[tuple[str, str]]) -> list[str]:
    found = [
        f".{n}" for name, value in attributes if name in ("class", "id", "role") for n in _NAME.findall(value.lower())
    ]
    return found if len(found) <= MOST_NAMES else found[: MOST_NAMES // 2] + found[-MOST_NAMES // 2 :]


def _attributes(page: str, at: int) -> tuple[list[tuple[str, str]], int]:
    """Attributes of the tag whose name ends at ``at``, and where the tag ends; -1 if it
    never does."""
    found: list[tuple[str, str]] = []
    while match := _ATTRIBUTE.match(page, at):
        at, value = match.end(), match[2] or ""
        if value in ('"', "'"):
            end = page.find(value, at)
            if end < 0:
                return found, -1
            value, at = page[at:end], end + 1
        found.append((match[1].lower(), references.unescape(value)))
    end = page.find(">", at)
    return found, end


def _read(page: str, reader: _Reader) -> None:
    at = 0
    while at < len(page):
        opened = page.find("<", at)
        if opened != at:
            end = len(page) if opened < 0 else opened
            reader.text(references.unescape(page[at:end]))
            at = end
            continue
        tag = _TAG.match(page, at)
        if tag and tag[1]:  # an end tag
            end = page.find(">", tag.end())
            reader.end(tag[2].lower())
        elif tag:
            name = tag[2].lower()
            attributes, end = _attributes(page, tag.end())
            if end < 0:
                return
            reader.start(name, _names(attributes))
            if page[end - 1] == "/" and name not in VOID:
                reader.end(name)
            elif name in RAW:
                close = _RAW_END[name].search(page, end)
                inside = page[end + 1 : close.start() if close else len(page)]
                reader.text(references.unescape(inside) if name in ("title", "textarea") else inside)
                end = close.start() - 1 if close else -1
        elif page.startswith("<!--", at):
            end = page.find("-->", at + 2 if page.startswith("<!-->", at) else at + 4)
            end = end + 2 if end >= 0 else -1
        elif page[at + 1 : at + 2] in ("!", "?", "/"):
            end = page.find(">", at)
        else:  # no markup
            after = page.find("<", at + 1)
            after = len(page) if after < 0 else after
            reader.text(references.unescape(page[at:after]))
            at = after
            continue
        if end < 0:
            return
        at = end + 1


def leaf_blocks(html: str | None) -> list[Block]:
    """The page's blocks."""
    reader = _Reader()
    _read(html or "", reader)
    reader.end_block()
    return reader.blocks
