"""Byte-level BPE texts as memoised chunks.

A byte-level BPE splits a text into pre-tokens by a fixed pattern and merges inside each. A single space
that a visible character follows always starts a pre-token, so a text can be cut before its spaces and
each chunk handled, and remembered, by itself. Texts in which a space is followed by white space or the
end, or that hold a special token's string, take the pattern over the whole text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import regex

# The pre-token pattern of byte-level BPE, and the printable stand-in of each byte.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008" \
        "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

_ASCII_PAIRS = [" " + c for c in WHITE if c.isascii()]
_OTHER_PAIRS = [" " + c for c in WHITE if not c.isascii()]


def byte_symbols() -> list[str]:
    """Stand-in character of every byte: itself if printable, else one above 255."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]


def load_merges(path: str) -> tuple[dict[int, int], list[int], list[int], list[str]]:
    """Of a tokenizers file: rank by adjacent pair (``left << 32 | right``), merged symbol by rank, symbol
    of each byte, strings of the special tokens. Symbols are the vocabulary's numbers."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
    return ranks, [vocab[a + b] for a, b in pairs], [vocab[s] for s in byte_symbols()], \
        [t["content"] for t in spec["added_tokens"]]


class PreTokenIds:
    """Ids of a chunk from the ``tokenizers`` model itself, one pre-token after the other: the whole ``encode``
    takes more than twice as long on texts of a few characters."""

    def __init__(self, tokenizer):
        self.tokenize = tokenizer.model.tokenize
        self.stand_in = dict(enumerate(byte_symbols()))

    def __call__(self, chunk: str) -> list[int]:
        if chunk.isascii() and chunk[1:].isalpha() and chunk[0] == " ":  # one pre-token; only its space has a stand-in
            return [t.id for t in self.tokenize(self.stand_in[32] + chunk[1:])]
        return [t.id for word in PRE_TOKEN.findall(chunk)
                for t in self.tokenize(word.encode().decode("latin-1").translate(self.stand_in))]


class ChunkMemo(dict):
    """Value per chunk, worked out on first use. A cache only: at ``limit`` chunks the older generation is
    let go, which bounds memory and changes no result."""

    def __init__(self, value: Callable[[str], object], limit: int = 300_000, longest: int = 64):
        super().__init__()
        self.value, self.limit, self.longest, self.older = value, limit, longest, {}

    def __missing__(self, chunk: str):
        out = self.older.get(chunk)
        if out is None:
            out = self.value(chunk)
        if len(chunk) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[chunk] = out
        return out


def cuttable(text: str, specials: list[str]) -> bool:
    """Whether the text can be cut before its spaces without a cut inside a pre-token."""
    if any(s in text for s in specials) or text.endswith(" ") or any(p in text for p in _ASCII_PAIRS):
        return False
    return text.isascii() or not any(p in text for p in _OTHER_PAIRS)


def chunks(text: str, specials: list[str]) -> list[str] | None:
    """The text cut before its spaces, or None if that could cut inside a pre-token."""
    if not cuttable(text, specials):
        return None
    words = text.split(" ")
    out = [" " + w for w in words]
    out[0] = words[0]
    return out if out[0] else out[1:]


def segments(text: str, specials: list[str]) -> list[tuple[str, bool]]:
    """(part, is special) of a text: strings of special tokens stand by themselves."""
    if not specials:
        return [(text, False)] if text else []
    parts = re.split("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")", text)
    return [(p, k % 2 == 1) for k, p in enumerate(parts) if p]
