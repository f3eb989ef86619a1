"""Secrets in text: fixed patterns, and novelty under a primed compressor.

The patterns find assignments to names such as password, access keys, and long runs of hexadecimal digits. Beyond them, every long
run of key characters in a sensitive context is a candidate, and so is every value set to a sensitive name, such as a passphrase or a
private key, that mixes kinds of characters: its novelty is the number of bytes that it adds to the
compressed size of the text around it, under a zstandard dictionary of code words and identifiers. Candidates that add nearly as
many bytes as a random string would are reported; words, paths and repetitions of the surroundings add few.

Positions are code points, ends exclusive. Defined results: NULL is an empty text; without finds the list is empty. Spans of one
kind never overlap; a candidate within a pattern's span is not reported again, one that reaches beyond it is reported whole. Equal rows give equal spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from monthclose.llm.common import small_batches

# The kinds in their order, and the patterns with the least lengths of what they find.
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

#: Candidates: length, characters of context on each side, and added bytes per character of a random string of 64 letters.
LEAST_NOVEL, CONTEXT, LEAST_BYTES = 20, 200, 0.6
_NOVEL = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_NOVEL},}}")
_KEY_LIKE = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])", re.S)
_SENSITIVE = re.compile(r"(?ai)key|secret|token|passw|passphrase|credential|bearer|authorization|private|signature|client_id")
#: Values set to sensitive names: least length, and kinds of characters (lower case, upper case, digits, others) in one.
LEAST_VALUE, LEAST_KINDS = 12, 2
_SET = re.compile(rf"[:=](?=\s{{0,2}}[\"']?[^\s\"'<>()\[\]{{}},;`]{{{LEAST_VALUE}}})")
_NAME = re.compile(
    r"(?ai:key|secret|token|passw(?:or)?d|passphrase|credentials?|bearer|authorization|private|signature|client_id)"
    r"[A-Za-z0-9_]{0,40}[\"']?\s{0,2}\Z")
_VALUE = re.compile(r"\s{0,2}[\"']?([^\s\"'<>()\[\]{},;`]+)")
_CHARACTERS = tuple(re.compile(p) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
# What code and settings are full of; it primes the compressor.
PRIMER = (
    "public static void return import from class function const export default require module package namespace "
    "self this null None true false undefined string integer boolean float double array object dictionary list map set "
    "application/json Content-Type Authorization: Bearer Accept-Encoding User-Agent Mozilla/5.0 https://www. http:// .com .org "
    "api_key apikey access_key secret_key private_key public_key client_id client_secret access_token refresh_token "
    "password passwd passphrase credential username database hostname localhost connection_string configuration settings "
    "environment variable production development testing example sample placeholder changeme your_key_here xxxxxxxxxxxx "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 1234567890abcdef deadbeef "
    "BEGIN RSA PRIVATE KEY END CERTIFICATE ssh-rsa sha256 md5 base64 utf-8 index.html node_modules site-packages "
    "getElementById addEventListener setAttribute createElement toString valueOf hashCode equals compareTo iterator ")


@cache
def _compressor() -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(PRIMER.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=6, dict_data=primed, write_content_size=False, write_dict_id=False)


def novelty(text: str, start: int, end: int) -> float:
    """Compressed bytes that the candidate adds to its surroundings, per character."""
    around = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    size = lambda s: len(_compressor().compress(s.encode("utf-8", "replace")))
    return (size(around + text[start:end]) - size(around)) / (end - start)


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then by kind."""
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    base = sorted((s, e) for _, s, e in found)
    candidates = [m.span() for m in _NOVEL.finditer(text)
                  if _KEY_LIKE.match(m[0]) and _SENSITIVE.search(text[max(0, m.start() - 60) : m.start()])]
    done = 0
    for sign in _SET.finditer(text):
        if sign.end() < done or not _NAME.search(text, max(0, sign.start() - 64), sign.start()):
            continue
        m = _VALUE.match(text, sign.end())
        done, value = m.end(), m[1].rstrip(".:!?")
        if len(value) >= LEAST_VALUE and sum(bool(c.search(value)) for c in _CHARACTERS) >= LEAST_KINDS:
            candidates.append((m.start(1), m.start(1) + len(value)))
    last = 0
    for s, e in sorted(candidates, key=lambda c: (c[0], -c[1])):
        if s >= last and not any(a <= s and e <= b for a, b in base) and novelty(text, s, e) >= LEAST_BYTES:
            found.append(("novel", s, e))
            last = e
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every stretch that spans cover replaced by one mark."""
    if not spans:
        return text
    parts, at = [], 0
    merged: list[list[int]] = []
    for _, s, e in spans:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        parts += [text[at:s], "[REDACTED]"]
        at = e
    return "".join(parts) + text[at:]


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts by pattern, digest of the patterns' spans, all spans) of every row, from its whole text."""
    small_batches(docs.sparkSession)
    names = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"]
    schema = (docs.select(id_col).schema.simpleString()[7:-1]
              + ", n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                spans = find(value.as_py())
                count = [sum(k == kind for k, _, _ in spans) for kind in KINDS]
                base = digest([s for s in spans if s[0] != "novel"])
                rows.append((*count[:3], hashlib.sha256(base.encode()).hexdigest(), digest(spans), count[3]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def without_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns; found secrets are replaced by a mark, and the length follows the text."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(place).to_pylist()
            new = [redacted(t, find(t)) for t in old]
            out = batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))
            if length is not None:
                field = batch.schema.field(length)
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, batch.column(length).to_pylist(), strict=True)]
                out = out.set_column(length, field, pa.array(sizes, field.type))
            yield out

    return docs.mapInArrow(run, docs.schema)
