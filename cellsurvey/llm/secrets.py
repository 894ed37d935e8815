"""Secret scans: keyword automaton, anchored expressions near its hits, checksums inside the match.

A text is searched once with an Aho-Corasick automaton over all keywords; expressions run only where a keyword
was seen, anchored there. Hexadecimal runs have no keyword of their own: for them the text is mapped to two symbols
(hexadecimal or not), where a run of sixteen *is* a keyword. Kinds whose tokens carry a checksum are reported only
if it holds.

NULL and empty texts have no secrets; texts of any length are scanned whole; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from cellsurvey.llm.common import own_columns, slices

KINDS = ("assign", "access", "hex", "github", "npm", "bip32")
BASE_KINDS = KINDS[:3]

# fixed values: expressions and lengths of the contract, prefixes and lengths of public token formats
_ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
_NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
_BIP32 = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_MIN_ASSIGN, _MIN_ACCESS, _MIN_HEX = 12, 18, 16

_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_HEX_CLASS = bytes(ord("h") if chr(c) in "0123456789abcdef" else ord(".") for c in range(256))


def _base62(digits: str) -> int:
    value = 0
    for c in digits:
        value = value * 62 + _BASE62.index(c)
    return value


def crc_token(match: re.Match) -> bool:
    """Last six base-62 digits are the CRC-32 of the thirty before."""
    return _base62(match[2]) == zlib.crc32(match[1].encode())


def base58_check(match: re.Match) -> bool:
    """82 bytes in base 58, the last four the double SHA-256 of the others."""
    value = 0
    for c in match[0]:
        value = value * 58 + _BASE58.index(c)
    if value.bit_length() > 82 * 8:
        return False
    data = value.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


def _automaton(words) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in words:
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


class Scanner:
    """The automata and the search over one text."""

    def __init__(self):
        self.keywords = _automaton(
            [(k, "assign") for k in _ASSIGN_KEYS] + [("akia", "access"), ("npm_", "npm"), ("xprv", "bip32")]
            + [(f"gh{c}_", "github") for c in "pousr"])
        self.runs = _automaton([("h" * _MIN_HEX, "hex")])

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, leftmost and non-overlapping per kind."""
        starts: dict[str, list[int]] = {}
        for end, (size, kind) in self.keywords.iter(ascii_lower(text)):
            starts.setdefault(kind, []).append(end - size + 1)
        out = []
        for kind, expression, keep in (
            ("assign", _ASSIGN, lambda m: len(m[2]) >= _MIN_ASSIGN),
            ("access", _ACCESS, lambda m: len(m[0]) >= _MIN_ACCESS),
            ("github", _GITHUB, crc_token), ("npm", _NPM, crc_token), ("bip32", _BIP32, base58_check),
        ):
            done = 0
            for at in sorted(starts.get(kind, ())):
                if at >= done and (m := expression.match(text, at)):
                    done = m.end()
                    if keep(m):
                        out.append((kind, m.start(), m.end()))
        out += self.hex_runs(text)
        return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))

    def hex_runs(self, text: str) -> Iterator[tuple[str, int, int]]:
        # one symbol per code point: what is not Latin-1 becomes '?', which is no hexadecimal digit
        classes = text.encode("latin-1", "replace").translate(_HEX_CLASS).decode("latin-1")
        at = 0
        while (hit := next(self.runs.iter(classes, at), None)) is not None:
            start = hit[0] - _MIN_HEX + 1
            end = _HEX.match(text, start).end()
            yield "hex", start, end
            at = end


def ascii_lower(text: str) -> str:
    """A-Z lowered, every other character kept in its place."""
    low = text.lower()
    # lowering never shortens a character, so equal lengths mean equal places; extra hits are checked anyway
    return low if len(low) == len(text) else text.translate(_ASCII_LOWER)


def digest_text(spans, kinds=KINDS) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans if k in kinds)


_SCHEMA = "doc_id bigint, kinds array<string>, starts array<int>, ends array<int>, secrets array<string>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in slices(batches):
        texts = batch.column(1).to_pylist()
        found = [scanner.spans(t) if t else [] for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array([[s[0] for s in f] for f in found], pa.list_(pa.string())),
                pa.array([[s[1] for s in f] for f in found], pa.list_(pa.int32())),
                pa.array([[s[2] for s in f] for f in found], pa.list_(pa.int32())),
                pa.array([[t[s:e] for _, s, e in f] for t, f in zip(texts, found)], pa.list_(pa.string())),
            ],
            names=["doc_id", "kinds", "starts", "ends", "secrets"],
        )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: parallel arrays of kinds, starts, ends and matched texts. A narrow step, no shuffle."""
    return own_columns(docs, "doc_id", "text").mapInArrow(_scan, _SCHEMA)


def _redactor(at: int, size_at: int):
    def redact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in slices(batches):
            texts = [redacted(t, scanner.spans(t)) if t else t for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if size_at >= 0:
                old = columns[size_at].to_pylist()
                columns[size_at] = pa.array(
                    [n if t is None or n is None else len(t) for n, t in zip(old, texts)], batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return redact_batches


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span replaced by ``<kind>``; overlapping ones by the kind of the first."""
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """The same columns with secrets replaced in ``text``, and ``n_chars`` brought up to date. A narrow step."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    size_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else -1
    return docs.mapInArrow(_redactor(docs.columns.index("text"), size_at), schema)
