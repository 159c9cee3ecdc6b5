"""Token ids of whole texts, by the file of a public tokenizer.

The file is one of the ``tokenizers`` library. That of a byte-level vocabulary is also
read into ``tiktoken``, which merges the same pairs in the same order three times as
fast; texts that hold the string of a special token go through ``tokenizers`` itself.
Long texts are encoded in slices, cut before a single blank between printable
characters, where no token of a byte-level vocabulary can span.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np

#: How a byte-level tokenizer splits a text before it merges bytes.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that no tokenizer takes for white space; a cut has one on either side of
#: the blank.
SOLID = "[!-~¡-ᙿぁ-퟿]"
CUT = re.compile(f"(?<={SOLID})(?= {SOLID})")
#: Characters that are encoded at once.
SLICE = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the file of a byte-level vocabulary: printable
    bytes for themselves, the others in order from the 257th character on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Ids:
    """Ids of texts as bytes, four for each id, the lowest first."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        split = layout["pre_tokenizer"] or {}
        if split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or layout["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        letters = byte_letters()
        self.special = [token["content"] for token in layout["added_tokens"]]
        ranks = {
            bytes(letters[c] for c in word): i
            for word, i in layout["model"]["vocab"].items()
            if word not in self.special
        }
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> bytes:
        """All ids of a text."""
        if any(word in text for word in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        return b"".join(self._slices(text))

    def _slices(self, text: str) -> Iterator[bytes]:
        at = 0
        while at < len(text):
            cut = CUT.search(text, at + SLICE) if at + SLICE < len(text) else None
            end = cut.start() if cut else len(text)
            yield np.array(self.fast.encode_ordinary(text[at:end]), dtype="<u4").tobytes()
            at = end
