"""Secret scans by assignment-aware lexing.

Source and configuration are read as name-literal pairs: ``name = literal``, ``name: literal``, ``name := literal``, ``name => literal``, with an annotation
(``name: type = literal``), a subscript (``table["name"] = literal``), a tag (``<name>literal</name>``), or with the literal on the next, deeper
line of a YAML block.  A literal stands in quotes of any kind, with a prefix, over several lines in triple quotes or
backticks, or bare to the next space; literals joined by ``+`` are one.  Names bound to a literal are constants until a line begins
further left than theirs; a later ``other = name`` hands the literal's place on to the other name.  A literal is reported when a
name it reaches is sensitive and the literal looks random enough for that name.
Pattern spans of the three plain kinds are always kept beside the method's own.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# The plain patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24}")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# Weights of the parts of a name.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 2, "apikey": 3, "credential": 3, "credentials": 3,
    "privatekey": 3, "accesskey": 3, "auth": 1, "authorization": 2, "bearer": 2, "key": 1, "private": 1, "access": 1, "api": 1,
    "signing": 1, "encryption": 1, "salt": 1, "cookie": 1, "session": 1, "webhook": 1,
}
HARMLESS = {"public", "count", "length", "limit", "size", "name", "type", "id", "index", "path", "url", "file", "test", "example", "sample", "dummy", "placeholder"}

# No length ends a name or a literal: possessive parts keep this linear.  A quoted literal holds escapes as they are written.
_QUOTED = (
    r"""(?:[bBrRfFuU]{1,2}(?=["'`]))?+(?:\"\"\"((?:[^"\\]|\\(?s:.)|"(?!""))*+)\"\"\"|'''((?:[^'\\]|\\(?s:.)|'(?!''))*+)'''"""
    r"""|"((?:[^"\n\\]|\\(?s:.))++)"|'((?:[^'\n\\]|\\(?s:.))++)'|`((?:[^`\\]|\\(?s:.))++)`)"""
)
_BARE = r"([A-Za-z0-9+/_.=$!@#%^&*~?-]++(?![(\[]))"
_NEXT_LINE = r"[ \t]*+(?:[|>][-+]?[ \t]*+)?\r?\n[ \t]++(?=[^\r\n:]*+(?:\r?\n|\Z))"
_PAIR = re.compile(
    r"""(?<![\w.$-])["']?([A-Za-z_][\w.$-]*+)["']?\]?[ \t]*+"""
    r"""(?::[ \t]*+[A-Za-z_][\w.]*+(?:\[[^\]\n]*+\])?[ \t]*+=(?![=~>])|:=|=>|=(?![=~])|:(?![:/])(?:"""
    + _NEXT_LINE
    + r""")?+)[ \t]*+(?:"""
    + _QUOTED
    + "|"
    + _BARE
    + ")",
    re.ASCII,
)
_JOINED = re.compile(r"[ \t]*+\+[ \t]*+(?:\r?\n[ \t]*+)?" + _QUOTED, re.ASCII)
_TAG = re.compile(r"<([A-Za-z_][\w.-]*+)>[ \t]*+([^<>\n]++)</\1>", re.ASCII)
_LINE = re.compile(r"^([ \t]*+)\S", re.MULTILINE)
#: Groups of the patterns that hold a literal; the last one is bare.
_LITERALS = range(2, 8)
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")


def name_score(name: str) -> int:
    """How sensitive a target name is: the weights of its parts; a harmless last part cancels them."""
    parts = [p.lower() for p in _PART.findall(name)]
    if not parts or parts[-1] in HARMLESS or any(p in ("public", "example", "dummy", "placeholder") for p in parts):
        return 0
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return sum(SENSITIVE.get(p, 0) for p in parts + pairs)


def entropy(value: str) -> float:
    """Shannon entropy of the characters, in bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def literal_score(value: str, spaced: bool = False) -> int:
    """How much a literal looks like a secret, 0 to 4; one with spaces (a passphrase) only if ``spaced``, and then it is a long one.  A private key in PEM form does."""
    if _PEM.search(value):
        return 4
    if len(value) < 8 or " " in value and not (spaced and len(value) >= 16):
        return 0
    kinds = bool(re.search("[a-z]", value)) + bool(re.search("[A-Z]", value)) + bool(re.search("[0-9]", value)) + bool(re.search("[^A-Za-z0-9]", value))
    return (len(value) >= 16) + (kinds >= 2) + (entropy(value) >= 3) + (kinds >= 3)


class _Scopes:
    """Constants by name, gone when a line begins further left than the one that bound them."""

    def __init__(self, text: str) -> None:
        self.text, self.at, self.indent = text, 0, 0
        self.bound: list[tuple[int, str]] = []
        self.known: dict[str, list[list[tuple[int, int]]]] = {}

    def reach(self, place: int) -> int:
        """Closes what ends before ``place``; how far its line is indented."""
        for m in _LINE.finditer(self.text, self.at, place + 1):
            self.indent = len(m[1])
            while self.bound and self.bound[-1][0] > self.indent:
                self.known[self.bound.pop()[1]].pop()
        self.at = max(self.at, place + 1)
        return self.indent

    def bind(self, indent: int, name: str, spans: list[tuple[int, int]]) -> None:
        self.bound.append((indent, name))
        self.known.setdefault(name, []).append(spans)

    def of(self, name: str) -> list[tuple[int, int]] | None:
        held = self.known.get(name)
        return held[-1] if held else None


def _literal(m: re.Match) -> tuple[int, int]:
    return next(m.span(k) for k in range(1, len(m.groups()) + 1) if m[k] is not None)


def _told(name: str, value: str) -> bool:
    weight = name_score(name)
    return weight >= 2 and literal_score(value, weight >= 3) >= (2 if weight >= 3 else 3)


def lexed(text: str) -> list[tuple[int, int]]:
    """Spans of literals that a sensitive name takes, directly or through constants."""
    scopes, found = _Scopes(text), set()
    for m in _PAIR.finditer(text):
        name, bare = m[1], m[_LITERALS[-1]]
        spans = [next(m.span(k) for k in _LITERALS if m[k] is not None)]
        indent = scopes.reach(m.start(1))
        if bare is not None:
            if "://" in text[spans[0][0] : spans[0][1] + 3]:  # an address
                continue
            if _WORD.match(bare):
                held = scopes.of(bare)
                if held is None and ("." in bare or len(bare) < 16):
                    continue
                spans = held or spans
        else:
            end = m.end()
            while more := _JOINED.match(text, end):
                spans.append(_literal(more))
                end = more.end()
        scopes.bind(indent, name, spans)
        if _told(name, "".join(text[a:b] for a, b in spans)):
            found.update(spans)
    if "</" in text:
        found.update(m.span(2) for m in _TAG.finditer(text) if _told(m[1], m[2].strip()))
    return sorted(found)


KINDS = ("assign", "access", "hex", "lexed")


def scan(text: str) -> list[tuple[int, int, str]]:
    """All spans as (start, end, kind): those of the plain patterns, then the method's further ones."""
    spans: list[tuple[int, int, int]] = []
    if "=" in text or ":" in text or "</" in text:
        if ASSIGN.search(text):
            spans += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
        spans += [(*s, 3) for s in lexed(text)]
    if "AKIA" in text:
        spans += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    at = 0
    while m := HEX_LONG.search(text, at):  # the first 24 of a run begin where the run begins
        at = HEX.match(text, m.start()).end()
        spans.append((m.start(), at, 2))
    spans.sort(key=lambda s: (s[0], s[2]))
    return [(a, b, KINDS[k]) for a, b, k in spans]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def secret_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the plain kinds, their digest, and all spans as text.

    A null or empty text has no spans and the digest of the empty string.  Rows that repeat a key or have a null key
    are scanned each on its own; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for value in batch.column(1):
                spans = scan(value.as_py() or "")
                base = [s for s in spans if s[2] != "lexed"]
                for k in KINDS[:3]:
                    out[f"n_{k}"].append(sum(s[2] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            yield pa.RecordBatch.from_pydict({key: batch.column(0), **out})

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


MASK = "[secret]"


def mask(text: str, spans: list[tuple[int, int, str]], by: str = MASK) -> str:
    """The text with every span, overlapping ones as one, replaced."""
    parts, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            parts += [text[at:start], by]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns, with all found spans of the text masked; a null text stays null."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [None if t is None else mask(t, s) if (s := scan(t)) else t for t in old]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
