"""Secret scan: Aho-Corasick keyword prefilter, anchored patterns at the hits, embedded checksums.

One pass over each text. The automaton runs over the lower-cased text and yields the places where a
keyword starts; only there is a pattern matched, anchored at the hit. Runs of hexadecimal digits have no
keyword, so the text is first mapped to a two-letter class alphabet, in which "32 digits in a row" is one
literal that is searched the same way. Token kinds that carry a checksum are reported only if it holds.

Everything works on UTF-8 bytes (each pattern is ASCII, so byte and character matches are the same);
offsets are converted to code points at the end.

Cases: a null text is scanned as empty; an empty text has no spans (``base_sha256`` is the hash of the
empty string); repeated rows give repeated results; a null id stays null; an empty table gives no rows;
further input columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import importable_on_workers, sliced, utf8

# The base kinds and the patterns of all kinds.
BASE_KINDS = ["assign", "access", "hex"]
CHECKED_KINDS = ["github", "npm", "jwt", "xprv"]
KINDS = BASE_KINDS + CHECKED_KINDS
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_DIGITS = "0123456789abcdef"
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KEYWORDS = {  # lower-cased keyword -> kind
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github",
    "ghs_": "github", "ghr_": "github", "npm_": "npm", "eyj": "jwt", "xprv": "xprv",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

_HEX_CLASS = bytes(ord("h") if chr(b) in HEX_DIGITS else ord(".") for b in range(256))
_WORD = frozenset(BASE62 + "_")


def crc_suffix(payload: str) -> str:
    """CRC-32 of ``payload`` as six base-62 digits, the last part of a checked token."""
    n, out = zlib.crc32(payload.encode()), ""
    while n:
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out.rjust(6, "0")


def _crc_holds(m: re.Match) -> bool:
    return crc_suffix(m[1]) == m[2]


def _json_part(part: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except (ValueError, binascii.Error, RecursionError):
        return False


def _jwt_holds(m: re.Match) -> bool:
    return _json_part(m[1]) and _json_part(m[2])


def _base58_check_holds(m: re.Match) -> bool:
    n = 0
    for ch in m[0]:
        n = n * 58 + BASE58.index(ch)
    if n.bit_length() > 82 * 8:
        return False
    raw = n.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


# kind -> (pattern matched at the hit, test that a match must pass, whether the hit must start a word)
_RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= MIN_ASSIGN, False),
    "access": (ACCESS, lambda m: len(m[0]) >= MIN_ACCESS, False),
    "github": (GITHUB, _crc_holds, True),
    "npm": (NPM, _crc_holds, True),
    "jwt": (JWT, _jwt_holds, True),
    "xprv": (XPRV, _base58_check_holds, True),
}


def keyword_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (len(word), kind))
    automaton.make_automaton()
    return automaton


def scan(data: bytes, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every span of one text in code points, by start, then kind."""
    hits: dict[str, list[int]] = {}
    for end, (length, kind) in automaton.iter(data.lower().decode("latin-1")):
        hits.setdefault(kind, []).append(end + 1 - length)
    found = []
    if hits:
        text = data.decode("latin-1")
        for kind, starts in hits.items():
            pattern, holds, whole_word = _RULES[kind]
            free = 0  # matches of a kind do not overlap: a hit inside the last match is passed over
            for start in sorted(starts):
                if start < free or (whole_word and start and text[start - 1] in _WORD):
                    continue
                if m := pattern.match(text, start):
                    free = m.end()
                    if holds(m):
                        found.append((start, KINDS.index(kind), free))
    classes = data.translate(_HEX_CLASS)
    run, hex_kind = b"h" * MIN_HEX, KINDS.index("hex")
    start = classes.find(run)
    while start >= 0:
        end = classes.find(b".", start)
        end = len(classes) if end < 0 else end
        found.append((start, hex_kind, end))
        start = classes.find(run, end)
    found.sort()
    return _code_points(data, found)


def _code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or data.isascii():
        return spans
    at, seen, known = 0, 0, {}
    for offset in sorted({x for start, _, end in spans for x in (start, end)}):
        seen += len(data[at:offset].decode("utf-8"))
        at, known[offset] = offset, seen
    return [(known[start], kind, known[end]) for start, kind, end in spans]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = keyword_automaton()
    for batch in sliced(batches):
        columns: dict[str, list] = {f"n_{kind}": [] for kind in KINDS} | {"base_sha256": [], "spans": []}
        for data in utf8(batch.column(1)):
            spans = scan(data or b"", automaton)
            for k, kind in enumerate(KINDS):
                columns[f"n_{kind}"].append(sum(s[1] == k for s in spans))
            base = _joined([s for s in spans if s[1] < len(BASE_KINDS)])
            columns["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            columns["spans"].append(_joined(spans))
        arrays = [pa.array(v, pa.int64() if name.startswith("n_") else pa.string()) for name, v in columns.items()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [batch.schema.names[0], *columns])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of secrets of every text.

    Returns the id, ``n_<kind>`` per kind, ``base_sha256`` (SHA-256 of the base kinds' joined spans) and
    ``spans`` (``kind:start:end`` of all kinds, comma-joined). Narrow: one pass, no shuffle.
    """
    importable_on_workers(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return source.mapInArrow(_scan_batches, f"doc_id {kind}, {counts}, base_sha256 string, spans string")
